import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_workers_do_not_need_the_package_on_their_path(tmp_path):
    """A driver started elsewhere, whose workers cannot import the package."""
    script = tmp_path / "job.py"
    script.write_text(
        textwrap.dedent(
            f"""
            import importlib.util
            spec = importlib.util.spec_from_file_location("entry", {str(ROOT / "__spark_entry__.py")!r})
            entry = importlib.util.module_from_spec(spec)
            spec.loader.exec_module(entry)
            from pyspark.sql import SparkSession
            spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                     .config("spark.sql.shuffle.partitions", "2").getOrCreate())
            for name in ("embed_documents", "vector_topk_batch"):
                assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
            print("done")
            """
        )
    )
    out = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "done" in out.stdout, out.stderr[-2000:]
