"""Quality rules: against a plain version, and defined cases."""

import re
from collections import Counter

from dwellspark.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"
CLEAN = "The form of the house is that of a barn and it stands on a hill. "


def plain(text):
    """The base columns by plain loops."""
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def judged(spark, texts, **kwargs):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {r["doc_id"]: r for r in quality.judge(df, ["doc_id"], **kwargs).collect()}


def natural(n):
    return " ".join(f"the w{i} of" if i % 3 == 0 else f"word{chr(97 + i % 26)}{i}" for i in range(n))


def test_base_counts(spark):
    texts = [
        None, "", " \n\t\r\x0b\x0c ", "one", "a b c a b c", "a a a a", "x y z x y\nz x y z", "    x y", "# ** $%&|<> 😀 é", "a\nb\n a\na\na \n\na\n",
        "a b " * 30, CLEAN * 5, natural(200), "line of words\n" * 70, "long " + "q" * 100_000, natural(40_000) + " tail again " + natural(500), "a\r\nb\r\nb\r\n",
    ]
    for i, r in judged(spark, texts).items():
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == plain(texts[i]), (i, got)
        assert r["kept"] == (r["failed"] == "") and (not r["base_failed"] or not r["kept"])


def test_rules_of_the_table(spark):
    clean = natural(90)
    texts = [
        clean, clean.upper(), "### " * 20 + clean, " ".join("12345 67" for _ in range(300)) + clean, clean.replace("the ", "tho ").replace(" of", " oz"),
        "\n".join(f"- {clean[k : k + 60]}" for k in range(0, len(clean), 60)), "\n".join(f"{clean[k : k + 60]} ..." for k in range(0, len(clean), 60)),
        " ".join(f"{a}{b}" for a in "abcdefghij" for b in "the of at in".split()), " ".join("extraordinarily" + w for w in clean.split()),
    ]
    failed = {i: set(r["failed"].split(",")) for i, r in judged(spark, texts).items()}
    assert failed[0] == {""}
    for i, name in ((1, "capitals"), (2, "symbols"), (3, "lettered"), (4, "stop_words"), (5, "bullets"), (6, "ellipses"), (8, "mean_length_high")):
        assert name in failed[i], (i, failed[i])


def test_own_tables(spark):
    texts = [natural(60), natural(60) + " ###"]
    rules = (quality.Rule("no_symbol", "n_symbols", 0),)
    rows = judged(spark, texts, rules=rules, stop_words=("nothing",))
    assert rows[0]["kept"] and not rows[1]["kept"] and rows[1]["failed"] == "no_symbol" and not rows[1]["base_failed"]


def test_limits_are_exact(spark):
    """A ratio that equals its limit doesn't fail; 49 words do, 50 don't."""
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(100)]
    texts = [" ".join(words[:49]), " ".join(words[:50]), " ".join(words[:75] + words[:25]), " ".join(words[:73] + words[:25])]
    rows = judged(spark, texts, rules=())
    assert [rows[i]["base_failed"] for i in range(4)] == [True, False, False, True]
    assert 2 * rows[2]["n_repeat_words"] == rows[2]["n_words"]
    assert [rows[i]["base_failed"] for i in range(4)] == [plain(t)[-1] for t in texts]


def test_names_that_clash_and_empty_tables(spark):
    df = spark.createDataFrame([(None, natural(60), 1, 2, "x"), (None, natural(60), 1, 2, "x")], "doc_id bigint, text string, _words int, `n.words` int, `_TEXT` string")
    rows = quality.judge(df, df.columns).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0]["_TEXT"] == "x" and rows[0]["kept"]
    assert quality.judge(df.limit(0), ["doc_id"]).collect() == []


def test_no_python_in_the_plan(spark, data):
    from dwellspark.llm.queries import QUERIES

    plan = QUERIES["op13_quality_rules"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
