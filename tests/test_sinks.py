"""What sinks leave on disk."""

from pathlib import Path

from reviewlens.plans import source_queries
from reviewlens.sources import scratch
from reviewlens.sources.writers import write_table


def test_predictions_are_stored_compressed(spark, tmp_path):
    lines = [(n, n % 3, n % 50, n % 5, 1.5 * n, n % 50, 0.01 * (n % 10), 0.01 * (n % 8), "R" if n % 2 else "N", "O") for n in range(40)]
    names = "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice l_quantity l_discount l_tax l_returnflag l_linestatus"
    rows = spark.createDataFrame(lines, names.split())
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = {r.model: r.n for r in source_queries.prediction_sink(spark, str(tmp_path)).collect()}
    assert found == {"encoder/m0": 40, "baseline/m1": 40, "sft/m2": 40}
    stored = Path(scratch.run_folder(spark).removeprefix("file:"))
    newest = max(stored.glob("predictions-*"), key=lambda p: p.stat().st_mtime)
    parts = [p.name for p in newest.glob("part-*")]
    assert parts and all(p.endswith(".json.gz") for p in parts)
    write_table(rows, f"{tmp_path}/plain", "json")
    assert all(p.name.endswith(".json") for p in (tmp_path / "plain").glob("part-*"))
