import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streammart.functions.text import _splitter, register_word_table, words

TEXTS = [
    (1, "Red plate, RED-7"), (2, ""), (3, "实时数仓项目 v2"), (4, None), (5, "sparks数仓"),
    (6, "Été à Zürich, naïve ÇA"), (7, "红色T恤 C++ 卡拉OK wi-fi"), (8, "かな 한글 é"),
]
DICTIONARY = ["数仓", "实时", "实时数仓", "spark", "t恤", "c++", "卡拉ok", "wi-fi", "c"]
MORE = [f"unrelated{i}" for i in range(600)] + [f"词{i}" for i in range(600)]


def split(spark, dictionary=()):
    df = spark.createDataFrame(TEXTS, "n INT, s STRING")
    return {r["n"]: r["w"] for r in df.select("n", words("s", dictionary).alias("w")).collect()}


def test_without_dictionary(spark):
    out = split(spark)
    assert out[1] == ["red", "plate", "red", "7"]
    assert out[2] == [] and out[4] is None
    assert out[3] == ["实", "时", "数", "仓", "项", "目", "v2"]
    assert out[6] == ["été", "à", "zürich", "naïve", "ça"]
    assert out[8] == ["かな", "한글", "é"]


def test_longest_dictionary_word_first(spark):
    out = split(spark, DICTIONARY)
    assert out[3] == ["实时数仓", "项", "目", "v2"]
    assert out[5] == ["sparks", "数仓"]
    assert out[7] == ["红", "色", "t恤", "c++", "卡拉ok", "wi-fi"]


def test_size_of_the_dictionary_changes_nothing(spark):
    assert split(spark, DICTIONARY + MORE) == split(spark, DICTIONARY)
    assert split(spark, MORE) == split(spark)


@pytest.mark.parametrize("dictionary", [(), DICTIONARY, DICTIONARY + MORE])
def test_table_function_in_sql_gives_the_same(spark, dictionary):
    df = spark.createDataFrame(TEXTS, "n INT, s STRING")
    register_word_table(spark, "split_words", dictionary)
    out = spark.sql("SELECT n, word FROM {df}, LATERAL split_words(s)", df=df)
    if not dictionary:
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    expected = df.select("n", F.explode(words("s", dictionary)).alias("word"))
    assert rows(out) == rows(expected)


def test_documents_are_read_whole(spark):
    long = "word " * 30_000 + "last"
    df = spark.createDataFrame([(long,)], "s STRING").select(F.explode(words("s")).alias("w"))
    assert df.count() == 30_001 and df.filter("w = 'last'").count() == 1


def every_path(text, entries):
    """All ways to lay entries side by side in a text, as lists of (begin, end)."""
    def from_(at):
        yield []
        for begin in range(at, len(text)):
            for e in entries:
                if text.startswith(e, begin):
                    for rest in from_(begin + len(e)):
                        yield [(begin, begin + len(e)), *rest]
    return from_(0)


def test_smart_mode_takes_the_best_path(spark):
    draw = random.Random(4)
    for _ in range(150):
        entries = sorted({"".join(draw.choice("数仓实时") for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(1, 7))})
        text = "".join(draw.choice("数仓实时,") for _ in range(draw.randint(0, 9)))
        value = lambda p: (sum(e - b for b, e in p), -len(p), sum(b for b, _ in p))
        paths = list(every_path(text, entries))
        most = max(map(value, paths))
        expected = []
        for path in paths:
            if value(path) == most:
                cut, at = [], 0
                for begin, end in [*path, (len(text), len(text))]:
                    cut += [c for c in text[at:begin] if c != ","] + [text[begin:end]] * (end > begin)
                    at = end
                expected.append(cut)
        assert _splitter(entries)(text, True) in expected


def test_smart_and_longest_differ(spark):
    dictionary = ["实时数", "实时", "数仓项目", "数仓"]
    df = spark.createDataFrame([("实时数仓项目",), ("CD实时 数仓",), (None,)], "s STRING")
    cut = lambda smart: [r["w"] for r in df.select(words("s", dictionary, smart).alias("w")).collect()]
    assert cut(False) == [["实时数", "仓", "项", "目"], ["cd", "实时", "数仓"], None]
    assert cut(True) == [["实时", "数仓项目"], ["cd", "实时", "数仓"], None]


def test_a_long_dictionary_costs_no_more_per_text():
    short, text = DICTIONARY * 1, "红色t恤 实时数仓 spark wi-fi " * 2000
    long = short + [f"词{i}条" for i in range(500_000)]
    seconds = []
    for entries in (short, long):
        split = _splitter(sorted(set(entries)))
        split(text, True)
        begin = time.perf_counter()
        found = split(text, True)
        seconds.append(time.perf_counter() - begin)
        assert found[:3] == ["红", "色", "t恤"]
    assert seconds[1] < 5 * seconds[0] + 0.05
