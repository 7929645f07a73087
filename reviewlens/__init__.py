"""Review-moderation analytics as Spark jobs."""

from reviewlens.schemas import LABELS

__all__ = ["LABELS"]
