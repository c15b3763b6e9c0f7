import random

import pytest
from pyspark.sql import types as T

WORDS = "the of river stone and over light from house when bright number seven".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", ".", "ing"]) for _ in range(n))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("_row", "_norm", "_id", "fp", "word", "_s", "_text", "n_CHARS2", "a.b")],
                       T.StructField("n_chars", T.LongType())])

ODD = [(1, "Hello  world, a b c d"), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (5, "a" * 5000), (6, prose(1, 30_000)),
       (7, "Hello world,\na b c d"), (8, "Hello world, a b c d"), (8, "Hello world, a b c d"), (9, "çé 日本語 😀😀 ▁x \x00 </s> <|endoftext|> z"),
       (10, prose(2, 400)), (11, prose(2, 400)), (12, prose(3, 60)), (None, "null id words here now"), (13, "  two   spaces \n\n b")]


@pytest.fixture(scope="session")
def ready(spark):
    from panelspark.llm.shipping import ship_package
    from panelspark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd(ready, tmp_path_factory):
    """Odd rows with extra columns whose names the operators use themselves, read from files."""
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows = [(i, t, *["extra"] * 9, len(t) if t is not None else None) for i, t in ODD]
    ready.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return ready.read.parquet(path)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
