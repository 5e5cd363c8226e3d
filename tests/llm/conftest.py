import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from millrace.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"
LONG = ("lorem ipsum dolor sit amet " * 9000 + "token=abcdef0123456789abcdef mail me@site.example.org\n") * 2

AWKWARD = [
    (None, "Ein Satz ohne Nummer, der lang genug ist um gelesen zu werden.", "de", "s"),
    (1, None, "en", "s"), (2, "", "en", None), (3, " \t\n\x0b\x0c\r ", None, "s"), (4, "one two", "en", "s"),
    (5, "one two", "en", "s"), (5, "one two", "en", "s"), (6, "12345 !!! 67", "en", "s"),
    (7, LONG, "en", "s"), (8, "x" * 300_000, "en", "s"), (9, "1" * 300_000, "en", "s"),
    (10, "@" * 5000 + "." * 5000 + "+1" * 5000, "en", "s"),
    (11, "日本語のテキスト 😀 ́á \x00 \x1c <|endoftext|> <0x0A> ▁x", "ja", "s"),
    (12, LONG, "en", "s"), (13, "Tie " * 60, "en", "s"),
]


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="millrace-llm-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g"})
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="millrace-llm-")
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(root)
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns that clash with outputs."""
    rows = [(i, t, lang, src, len(t or ""), "x", 1, True, 0.5, "y") for i, t, lang, src in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 "spans string, n_words int, kept boolean, score double, fp string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, score int")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")
