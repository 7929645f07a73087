from reviewlens.functions import policy, text

__all__ = ["policy", "text"]
