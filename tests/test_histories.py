"""History files cut at their top-level keys: any splits give what a JSON parser gives."""

import json
import random

import pytest

from dwellspark.sources import histories

HARD = ['}', '{', '"', '\\', '\\"', '};', '{"a": {', '],[', 'é', '日本', '\n', ' }\\\\"} ', ',', '']


def made(rng, n):
    """A history whose texts are full of braces, quotes and escapes."""
    out = {}
    for i in range(n):
        text = "".join(rng.choice(HARD) for _ in range(rng.randrange(12)))
        snaps = [{"seen_at": f"2026-01-{d + 1:02d}T00:00:00+00:00", "price_eur": rng.choice([None, 0, 100 * d])} for d in range(rng.randrange(4))]
        out[f"{i}{rng.choice(HARD)}"] = {"first_seen": "2026-01-01T00:00:00+00:00", "snapshots": snaps, "latest": {"id": str(i), "title": text, "photos": [text, "x"], "area": None, "portal": "p"}}
    return out


def split_into(text, rng, size):
    """The text's rows (cut at closing braces), dealt to splits by their first byte as the reader does."""
    data, rows, at = text.encode(), [], 0
    while at < len(data):
        end = data.find(b"}", at)
        end = len(data) if end < 0 else end
        rows.append((at, data[at:end].decode()))
        at = end + 1
    return [("f", start // size * size, len(data), row) for start, row in rows]


@pytest.mark.parametrize("size", [7, 40, 300, 10**6])
def test_any_split_gives_the_same_entries(size):
    import pyarrow as pa

    rng = random.Random(size)
    for indent in (None, 2):
        want = made(rng, 25)
        rows = split_into(json.dumps(want, ensure_ascii=rng.random() < 0.5, indent=indent) + rng.choice(["", "\n", " \n "]), rng, size)
        by_split = {}
        for r in rows:
            by_split.setdefault(r[1], []).append(r)
        batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=list("abcd"))
        summaries = [r for part in by_split.values() for b in histories._summaries(iter([batch(part)])) for r in b.to_pylist()]
        begin, bad = histories._beginnings(summaries)
        assert bad == []
        found, pieces = [], {}
        for part in by_split.values():
            half = len(part) // 2
            for b in histories._entries(begin)(iter([batch(part[:half]), batch(part[half:])])):
                for r in b.to_pylist():
                    if r["whole"]:
                        found.append((r["place"], r["text"]))
                    else:
                        pieces.setdefault(r["open"], []).append((r["block"], r["text"], r["place"]))
        found += [(max(p for _, _, p in x if p is not None), "".join(t for _, t, _ in sorted(x, key=lambda y: y[0]))) for x in pieces.values()]
        got = {}
        for _, text in sorted(found):
            got |= json.loads("{" + text.lstrip(" \n,{") + "}")
        assert got == want and list(got) == list(want)
        assert size > 100 or len(by_split) > 10


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(4)
    want = made(rng, 300)
    (tmp_path / "all.json").write_text(json.dumps(want, ensure_ascii=False))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        entries, bad = histories.history_entries(spark, str(tmp_path))
        assert bad == [] and entries.rdd.getNumPartitions() > 10 and entries.count() == len(want)
        rows = histories.history_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    snaps = sorted((k, i, s["price_eur"]) for k, v in want.items() for i, s in enumerate(v["snapshots"]))
    assert sorted((r["id"], r["seq"], r["price_eur"]) for r in rows if r["seq"] is not None) == snaps
    assert {r["id"]: r["title"] for r in rows} == {k: v["latest"]["title"] for k, v in want.items()}
    places = {r["id"]: r["ordinal"] for r in rows}
    assert sorted(places, key=places.get) == list(want) and all(r["bad_record"] is None for r in rows)


def test_files_that_cannot_be_read(spark, tmp_path):
    good = {"first_seen": "2026-01-01", "snapshots": [], "latest": {"id": "x", "portal": "p"}}
    files = {
        "open.json": '{"1": {', "quote.json": '{"a": "x}', "text.json": "nonsense", "short.json": json.dumps({"a": good, "b": good})[:-1], "comma.json": json.dumps({"a": good})[:-1] + ", ",
        "after.json": json.dumps({"a": good}) + " x", "empty.json": "", "blank.json": " \n", "none.json": "{}", "odd.json": json.dumps({"ok": good, "no": [1, 2], "also": good, "last": good}),
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = histories.history_files(spark, str(tmp_path)).collect()
    assert {r["bad_record"].split("/")[-1] for r in rows if r["bad_record"] and r["bad_record"].endswith(".json")} == {"open.json", "quote.json", "text.json", "short.json", "comma.json", "after.json"}
    assert {r["id"] for r in rows if r["id"]} == {"ok", "last"}
    assert [r["bad_record"][:12] for r in rows if r["bad_record"] and "also" in r["bad_record"]] == ['{"no": [1, 2']
