"""Text functions and word rules on hand-made strings."""

import pytest
from pyspark.sql import functions as F

from wordlode.functions import text as T
from wordlode.functions.text import WordRule
from wordlode.profiles import CHINESE, LATIN


def value(spark, column, **cells):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()])
    return df.select(column).first()[0]


def test_clean_applies_rules_in_order(spark):
    rules = [("[0-9]kg", " "), ("[^a-z]+", " ")]
    assert value(spark, T.clean(F.col("t"), rules), t="a5kg b") == "a b"
    assert value(spark, T.clean(F.col("t"), rules[::-1]), t="a5kg b") == "a kg b"


def test_chinese_cleaning_leaves_only_han_runs(spark):
    assert len(CHINESE.cleaning) == 29
    text = "我要买5斤苹果，谢谢！abc 今天支付宝付款"
    cleaned = value(spark, T.clean(F.col("t"), CHINESE.cleaning), t=text)
    assert "支付宝" not in cleaned and "今天" not in cleaned and "a" not in cleaned
    assert "苹果" in cleaned


def test_sentences_split_trim_and_drop_empty(spark):
    text = "甲。 乙！？丙　…\n\n丁;"
    assert value(spark, T.sentences(F.col("t"), CHINESE.sentence_delimiters), t=text) == list("甲乙丙丁")
    assert value(spark, T.sentences(F.col("t"), CHINESE.sentence_delimiters), t="a.b") == ["a.b"]
    assert value(spark, T.sentences(F.col("t"), LATIN.sentence_delimiters), t="a.b") == ["a", "b"]


def test_words_and_stop_words(spark):
    tokens = T.words(F.col("t"), LATIN.separator)
    assert value(spark, tokens, t="Ab, c ab 1 D") == ["ab", "c", "ab", "d"]
    assert value(spark, T.without(tokens, ["c", "d"]), t="Ab, c ab 1 D") == ["ab", "ab"]
    assert value(spark, T.drop_blank(F.split("t", ",")), t="a, ,\t,b ") == ["a", "b"]


def test_valid_text_drops_broken_bytes_only(spark):
    raw = b"a\xff\xe4\xb8\xad\xe4\xbd\xef\xbf\xbdz"
    got = value(spark, T.valid_text(F.col("t")), t=bytearray(raw))
    assert got == raw.decode("utf-8", errors="ignore") == "a中�z"


def test_phrase_count_does_not_overlap(spark):
    assert value(spark, T.phrase_count(F.col("t"), F.lit("aa")), t="aaaa") == 2


@pytest.mark.parametrize("a, b, expected", [
    ("a b c", "b c d d", 0.804859), ("a", "a", 0.0), ("a", "a b", 1.442695), ("a", "b c", 0.0),
])
def test_sentence_similarity(spark, a, b, expected):
    got = value(spark, T.sentence_similarity(F.split("a", " "), F.split("b", " ")), a=a, b=b)
    assert got == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("rule, good, bad", [
    (WordRule("must_match", ("[一-龥]",)), "中a", "abc"),
    (WordRule("min_len", (2,)), "ab", "a"),
    (WordRule("not_match", ("[较很]",)), "苹果", "很红"),
    (WordRule("not_contains", ("微信", "a.c")), "abc", "加微信"),
    (WordRule("not_first_char", ("在",)), "苹果", "在家"),
    (WordRule("not_last_char", ("湖",)), "苹果", "西湖"),
    (WordRule("not_first2", ("昨天",)), "苹果", "昨天买"),
    (WordRule("not_last2", ("广场",)), "苹果", "大广场"),
    (WordRule("not_single_repeated",), "哈喽", "哈哈哈"),
    (WordRule("not_first_char", ("王",), at_len=3), "王小二郎", "王小二"),
    (WordRule("not_last_char", ("妈",), at_len=3), "妈妈", "他妈妈"),
    (WordRule("not_last2", ("老师",), at_len=3), "李大老师", "李老师"),
    (WordRule("not_contains", ("平安",), at_len=4), "平安", "一路平安"),
])
def test_word_rule(spark, rule, good, bad):
    check = T.acceptable(F.col("w"), [rule])
    assert value(spark, check, w=good) is True
    assert value(spark, check, w=bad) is False


@pytest.mark.parametrize("word, expected", [
    ("面膜", True), ("苹果汁", True), ("果", False), ("哈哈", False), ("好面膜", False), ("王面膜", False),
    ("面膜市场", False), ("月一", False), ("abc", False), ("三石", False),
])
def test_chinese_word_rules(spark, word, expected):
    assert value(spark, T.acceptable(F.col("w"), CHINESE.word_rules), w=word) is expected


@pytest.mark.parametrize("word, expected", [
    ("面膜", True), ("café", True), ("naïf", False), ("a b", False), ("a*b", False), ("龘", False),
    ("𝔘", False),
])
def test_charset(spark, word, expected):
    assert value(spark, T.in_charset(F.col("w")), w=word) is expected


# One text that a rule changes, and one of the same characters that it leaves.
CLEANED = (
    "一斤 果斤 5斤 的 老公 我说 让你 不够 补付款 未付 亲爱的 今天 相信 支付宝 星期三 周六 感谢 供养 参加 怎么 "
    "排球 六合彩 租金 都可 主持 下班 有限 居然 abc"
).split()
LEFT = (
    "斤一 斤果 斤5 苹果 公老 说我 你让 够不 付补款 付未 爱亲的 天今 信相 付支宝 期星三 六周 谢感 养供 加参 么怎 "
    "球排 合六彩 金租 可都 持主 班下 限有 然居 苹果"
).split()


def test_every_chinese_cleaning_rule(spark):
    assert len(CLEANED) == len(LEFT) == len(CHINESE.cleaning) == 29
    columns = [
        T.clean(F.lit(t), [rule]) for texts in (CLEANED, LEFT) for t, rule in zip(texts, CHINESE.cleaning)
    ]
    got = list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())
    assert [t for t, g in zip(CLEANED, got[:29]) if g.strip()] == []
    assert got[29:] == LEFT


# One word that a rule refuses, and one that it accepts.
REFUSED = "abc 果 更大 加一款式 苹果课 在家 大广场 帮忙人 果果果 毕加索 小妈妈 李子 一起 大师傅 一生平安 一七".split()
ACCEPTED = "苹果 苹果 苹果 加减 课苹果 家在 广场舞 人帮忙 果果树 毕业 妈妈 李子树 一起来 师傅 平安 苹果".split()


def test_every_chinese_word_rule(spark):
    assert len(REFUSED) == len(ACCEPTED) == len(CHINESE.word_rules)
    columns = [
        T.acceptable(F.lit(w), [rule]) for words in (REFUSED, ACCEPTED) for w, rule in zip(words, CHINESE.word_rules)
    ]
    got = list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())
    n = len(REFUSED)
    assert ([w for w, g in zip(REFUSED, got[:n]) if g], [w for w, g in zip(ACCEPTED, got[n:]) if not g]) == ([], [])
