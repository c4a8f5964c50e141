import pytest

from foliospark.llm.common import ready

LONG = "lorem ipsum dolor sit amet " * 8_000  # 216,000 characters without a line end
MANY_LINES = "\n".join(f"line {i} of a very long text" for i in range(3_000))

# Nulls in every column, empty and very long texts, ties and repeated rows, odd characters; further columns that clash with added or inner names.
ROWS = [
    (1, "The quick brown fox.\nAll rights reserved.", "en", "a"), (2, "The quick brown fox.\nAll rights reserved.", "en", "a"), (2, "The quick brown fox.\nAll rights reserved.", "en", "a"),
    (3, "", "en", "a"), (4, None, "de", "b"), (None, "no id here", None, None), (None, "no id here", None, None), (5, LONG, None, "b"), (6, MANY_LINES, "en", None),
    (7, "ÄÖÜ ß é ñ 中文 😀 \x00   end", "de", "b"), (8, "   \n\n\t ", "en", "a"), (9, "12345 67890 --- !!!", "en", "a"), (-3, "negative id", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASH = ["n_chars", "score", "label", "labels", "shard", "bytes", "hash", "n_lines", "lang_pred", "fingerprint", "fp", "component_id", "piece", "start", "length", "_host", "_text", "_n", "_found",
         "_digest", "_kept", "_words", "_lines", "places", "notices", "part", "key", "keys"]


@pytest.fixture(scope="session")
def ready_spark(spark):
    ready(spark)
    return spark


@pytest.fixture(scope="session")
def edge(ready_spark):
    from pyspark.sql import functions as F

    docs = ready_spark.createDataFrame(ROWS, SCHEMA)
    return docs.withColumns({c: F.lit(i).cast("bigint") for i, c in enumerate(CLASH)})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
