"""How often each word is searched for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.functions.text import words
from streammart.functions.times import whole_seconds
from streammart.operators.windows import tumbling_agg
from streammart.schemas import KEYWORD_STATS


def searches(pages: DataFrame) -> DataFrame:
    """Search texts and their time, cut to the second."""
    found = pages.filter("item_type = 'keyword' AND item IS NOT NULL")
    return found.select(F.col("item").alias("full_word"), whole_seconds("ts").alias("event_time"))


def keyword_stats(
    texts: DataFrame,
    text: str = "full_word",
    source: str = "SEARCH",
    size: str = "2 seconds",
    delay: str = "2 seconds",
    dictionary: Iterable[str] = (),
) -> DataFrame:
    """Word counts by window; a text without words adds nothing.

    On a stream the watermark follows the searches, not all page views, because
    Spark filters before it: the last windows are emitted with the next search.
    """
    tokens = texts.select("event_time", F.explode(words(text, dictionary)).alias("keyword"))
    counted = tumbling_agg(tokens, ["keyword"], {"ct": F.count(F.lit(1))}, size, delay=delay)
    return counted.withColumn("source", F.lit(source)).select(*KEYWORD_STATS)
