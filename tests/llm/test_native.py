"""Chat formatting, line dedup, decontamination, sharding, fixity: edge cases, and brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from kinweave.llm import chat, decontaminate, fixity, linededup, sharding

DOCS = "doc_id long, text string"


def _docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # columns that clash with names used inside
        for name in ("tie", "k1", "k2", "node", "label", "items", "n_words", "gone", "removed", "_row", "row_number", "shard"):
            df = df.withColumn(name, F.lit("mine"))
    return df


def test_long_native_texts(spark):
    """Long texts in decontamination, sharding and chat formatting."""
    words = [f"w{k % 9973}" for k in range(200_000)]
    item = " ".join(words[123_456:123_470])
    docs = _docs(spark, [(1, " ".join(words)), (2, "x" * 2_000_000)])
    items = spark.createDataFrame([("i", item)], "item_id string, text string")
    found = {r.doc_id: r for r in decontaminate.find(docs, items).collect()}
    places = [p for p in range(len(words) - 13) if words[p : p + 14] == words[123_456:123_470]]
    assert found[1].n_words == 200_000 and found[1].n_hit == 14 * len(places) and (found[2].n_words, found[2].n_hit) == (1, 0)
    assert {r["size"] for r in sharding.shard_rows(docs).collect()} == {len(" ".join(words)) + 1, 2_000_001}
    back = chat.read_back(chat.expand(_chat(spark, [(1, 0, "user", "[INST]" * 100_000), (1, 1, "assistant", "y" * 1_000_000)]))).first()
    assert [t.text for t in back.turns] == ["[INST]" * 100_000, "y" * 1_000_000] and back.replies == ["y" * 1_000_000]


def _chat(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    rng = random.Random(1)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\1", "<", "s>", "\n", "é", "a b", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(bits, k=rng.randint(0, 6)))) for c in range(12) for t in range(rng.randint(1, 6))]
    rows += [(None, 0, "user", None), (50, 0, None, "x"), (51, 0, "assistant", "first"), (51, 0, "assistant", "first"), (52, None, "user", "q"), (52, 1, "assistant", "")]
    back = {r.conv_id: r for r in chat.read_back(chat.expand(_chat(spark, rows).withColumn("example", F.lit(1)))).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv))
        assert [(x.role, x.text) for x in back[conv].turns] == [t[1:] for t in turns]
        assert list(back[conv].replies) == [t[2] for t in turns if t[1] == "assistant"]
    assert chat.expand(_chat(spark, [])).count() == 0


def test_chat_examples(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A</s>"), (1, 3, "user", "V"), (1, 4, "assistant", "B"), (1, 5, "user", "W")]
    out = chat.expand(_chat(spark, rows)).orderBy("tail", "example").collect()
    assert [r.tail for r in out] == [False, False, True]
    masked = [r.formatted[r.loss_start : r.loss_start + r.loss_length] for r in out]
    assert masked == ["A\\2", "B", ""] and out[1].formatted.startswith(out[0].formatted)
    assert out[0].formatted.count("</s>") == 3


def test_line_dedup_cases(spark):
    long = "one two three four five six seven eight nine ten eleven"
    swapped, dropped = long.replace("six", "6"), long.replace("six ", "")
    far = long.replace("two", "2").replace("ten", "10")
    rows = [
        (1, f"{long}\nshort line\n\nshort line"), (2, f"  {long.upper()} \nother"), (3, f"{swapped}\n{far}\nkeep"), (4, dropped), (5, None), (6, ""),
        (7, "short lime"), (7, "short lime"), (None, "null id"), (8, "null id"),
    ]
    out = linededup.dedup_lines(_docs(spark, rows, extra=True))
    assert "label" in out.columns and out.columns.count("removed") == 1
    got = [(r.doc_id, r.text, r.removed) for r in out.collect()]
    want = [(1, f"{long}\nshort line\n", 1), (2, "other", 1), (3, f"{far}\nkeep", 1), (4, "", 1), (5, None, 0), (6, "", 0), (7, "", 1), (7, "", 1), (None, "null id", 0), (8, "", 1)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert linededup.dedup_lines(_docs(spark, [])).count() == 0


def test_line_dedup_inner_blanks(spark):
    rows = [(1, "Click here now"), (2, "click  here now\nnew"), (3, "Click\there \t now"), (4, "Click here\x0b\x0cnow \r"), (5, "Clickhere now")]
    got = {r.doc_id: (r.text, r.removed) for r in linededup.dedup_lines(_docs(spark, rows)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("new", 1), 3: ("", 1), 4: ("", 1), 5: ("", 1)}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len, reverse=True)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def _units(line, same_digits=False):
    words = line.split()
    chars = list(line) if len(line) >= 10 else None
    return ("w", words) if len(words) >= 10 else chars and (re.sub("[^0-9]", "", line) if same_digits else "c", chars)


def test_line_keys(spark):
    """Keys and numbers of words against Python, on white space of every kind; the key of a line is worked out once."""
    rng = random.Random(12)
    texts = ["".join(rng.choices([*"aB\u00c4\u03a3\u0130 \t\r\x0b\x0c\x85\xa0", "  ", " c"], k=rng.randint(0, 12))) for _ in range(400)] + ["one two", " x ", "", "   "]
    df = _docs(spark, list(enumerate(texts)))
    key = linededup.line_key(F.col("text"))
    got = df.select("text", key.alias("key"), F.lower("text").alias("low"), linededup.n_words(key).alias("n")).collect()
    for r in got:
        assert r.key == re.sub("[ \t\r\x0b\x0c]+", lambda m: " " if m[0] != " " else m[0], r.low.strip(" \t\r\x0b\x0c"))
        assert r.n == len(r.key.split(" "))
    plan = linededup.lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize("same_digits", [False, True])
def test_line_dedup_short_and_unspaced(spark, same_digits):
    rng = random.Random(5)
    cjk = [chr(0x4E00 + rng.randrange(500)) for _ in range(60)]
    base = ["".join(rng.choices(cjk, k=n)) for n in (9, 10, 12, 40, 120)] + ["subscribe to our newsletter now!", "page 12 of the book", "😀" * 9 + "ab", "tiny"]
    lines = []
    for _ in range(150):
        line = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2])):
            i = rng.randrange(len(line))
            line[i : i + 1] = rng.choice([["7"], [], [line[i], "x"], [line[i], "😀"]])
        lines.append("".join(line).strip())
    seen, want = [], {}
    for d, line in enumerate(lines):
        u = _units(line, same_digits)
        want[d] = int(any(line == s or (u and (v := _units(s, same_digits)) and u[0] == v[0] and _near(u[1], v[1])) for s in seen))
        seen.append(line)
    got = {r.doc_id: r.removed for r in linededup.dedup_lines(_docs(spark, list(enumerate(lines))), same_digits).collect()}
    assert got == want and 20 < sum(want.values()) < 140


def test_line_dedup_long(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(150_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:70_000], "changed", *words[70_001:]])), (3, "".join(words)), (4, "?" + "".join(words)[1:])]
    assert {r.doc_id: r.removed for r in linededup.dedup_lines(_docs(spark, rows)).collect()} == {1: 0, 2: 1, 3: 0, 4: 1}


def test_line_dedup_of_a_megabyte(spark):
    """One unspaced line of a million characters with an insertion, a deletion and a replacement: work grows with its length."""
    rng = random.Random(9)
    line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    took = {}
    for n in (100_000, 1_000_000):
        own = line[:n]
        rows = [(1, own), (2, own[: n // 3] + "?" + own[n // 3 :]), (3, own[: n // 2] + own[n // 2 + 1 :]), (4, own[:-1] + "!"), (5, own[: n // 4] + "??" + own[n // 4 :])]
        began = time.time()
        assert {r.doc_id: r.removed for r in linededup.dedup_lines(_docs(spark, rows)).collect()} == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0}
        took[n] = time.time() - began
    assert took[1_000_000] < 25 * took[100_000]


def test_line_dedup_sql_has_the_same_rule(spark):
    """Inner white space and numbers, in Spark and in the SQL."""
    rows = [(1, "Click here now"), (2, "click  here now\nnew"), (3, "Click\there \t now"), (4, "Click here\x0b\x0cnow \r"), (5, "Page 3 of 10 pages"), (6, "Page 4 of 10 pages"), (7, "Page 44 of 10 pages"), (8, None)]
    rows += [(9, "one  two three four\tfive six seven eight nine ten"), (10, "one two three  four five six seven eight 9 ten\n \t"), (11, "x")]
    df = _docs(spark, rows)
    got = linededup.dedup_lines(df).selectExpr("doc_id", "n_lines", "removed", "CAST(length(coalesce(text, '')) AS bigint) AS kept_chars", "sha2(coalesce(text, ''), 256) AS kept_sha256")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(linededup.ORACLE).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    removed = {r[0]: r[2] for r in want}
    assert removed == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 1, 7: 1, 8: 0, 9: 0, 10: 1, 11: 0}


def test_line_dedup_brute_force(spark):
    rng = random.Random(2)
    base = [[rng.choice("abcdefgh") for _ in range(rng.randint(9, 14))] for _ in range(12)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(3):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                i = rng.randrange(len(words))
                words[i : i + 1] = rng.choice([["z"], [], [words[i], "y"]])
            lines.append(" ".join(words))
        rows.append((d, "\n".join(lines)))
    seen, want = [], {}
    for d, text in rows:
        gone = 0
        for line in text.split("\n"):
            u = _units(line)
            gone += any(s == line or (u and (v := _units(s)) and u[0] == v[0] and _near(u[1], v[1])) for s in seen)
            seen.append(line)
        want[d] = gone
    assert {r.doc_id: r.removed for r in linededup.dedup_lines(_docs(spark, rows)).collect()} == want


def _decontaminated(docs, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            for win in {tuple(iw[i : i + width]) for i in range(max(1, len(iw) - width + 1))} if iw else ():
                for s in range(len(w) - len(win) + 1):
                    if tuple(w[s : s + len(win)]) == win:
                        hit |= set(range(s, s + len(win)))
                        found.add("" if item is None else str(item))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(map(str, out))


def test_decontamination(spark):
    rng = random.Random(4)
    item = [rng.choice(["the", "of", "cat", "dog", "é", "x1"]) + rng.choice("abc") for _ in range(25)]
    items = [(1, " ".join(item)), (2, "Tiny item"), (10, " ".join(item[5:20])), (3, None), (4, "..."), (None, "odd one out")]
    docs = [(1, "pre " + ", ".join(item[3:18]).upper() + " post tiny ITEM"), (2, " ".join(item[:9])), (3, None), (4, ""), (5, "odd-one.out " * 3), (6, "a b c"), (6, "a b c"), (None, "tiny item")]
    docs += [(20 + k, " ".join(rng.choices(item, k=200))) for k in range(5)]
    schema = "item_id long, text string"
    out = decontaminate.find(_docs(spark, docs, extra=True), spark.createDataFrame(items, schema))
    assert out.columns.count("items") == 1 and "k1" in out.columns
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, list(r["items"]))) for r in out.collect()) == _decontaminated(docs, items)
    none = decontaminate.find(_docs(spark, docs), spark.createDataFrame([], schema)).collect()
    assert len(none) == len(docs) and not any(r.n_hit for r in none)
    assert decontaminate.find(_docs(spark, []), spark.createDataFrame(items, schema)).count() == 0


def _near_items(docs, items, within, width=10):
    """Items whose windows' two rarest terms stand near each other, by looking at all positions."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    n = Counter(w for _, t in docs for w in words(t))
    out = []
    for doc_id, text in docs:
        w, found = words(text), set()
        for item, t in items:
            iw = words(t)
            for i in range(max(1, len(iw) - width + 1)) if iw else ():
                ranked = sorted((n[x], j, x) for j, x in enumerate(iw[i : i + width]))
                a, b = ranked[0][2], ranked[min(1, len(ranked) - 1)][2]
                if ranked[0][0] and any(x == a and y == b and 0 < abs(p - q) <= within for p, x in enumerate(w) for q, y in enumerate(w)):
                    found.add("" if item is None else str(item))
        out.append((doc_id, sorted(found)))
    return sorted(map(str, out))


def test_proximity_of_items(spark):
    rng = random.Random(12)
    pool = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(pool, k=rng.randint(1, 14)))) for k in range(12)] + [(None, "w1 w2"), (50, None), (51, "never seen")]
    docs = [(k, " ".join(rng.choices(pool, k=rng.randint(0, 60)))) for k in range(40)] + [(90, items[0][1]), (90, items[0][1]), (91, None), (92, "W1... w2")]
    schema = "item_id long, text string"
    for within in (1, 7):
        out = decontaminate.find(_docs(spark, docs, extra=True), spark.createDataFrame(items, schema), within=within).collect()
        assert sorted(str((r.doc_id, list(r.near_items))) for r in out) == _near_items(docs, items, within)
        assert sorted(str((r.doc_id, r.n_words, r.n_hit, list(r["items"]))) for r in out) == _decontaminated(docs, items)
    assert decontaminate.find(_docs(spark, []), spark.createDataFrame(items, schema), within=3).count() == 0
    assert {tuple(r.near_items) for r in decontaminate.find(_docs(spark, docs), spark.createDataFrame([], schema), within=3).collect()} == {()}


def test_proximity(spark):
    docs = decontaminate.keyed(_docs(spark, [(1, "aa x x bb x aa"), (2, "aa x x x x x bb")]))
    index = decontaminate.postings(docs, spark.createDataFrame([("aa",), ("bb",)], "term string"))
    found = decontaminate.proximity(index, spark.createDataFrame([("aa", "bb")], "term_a string, term_b string"), 3).collect()
    assert sorted((r.position_a, r.position_b) for r in found) == [(0, 3), (5, 3)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 1000])
def test_feistel(spark, n):
    df = spark.range(n).select("id", sharding.permute(F.col("id"), n, 9).alias("p"))
    rows = df.withColumn("back", sharding.unpermute(F.col("p"), n, 9)).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)
    if n == 1000:
        assert [r.p for r in rows] != list(range(n))
        assert spark.range(1).select(sharding.row_of(F.lit(rows[5].p % 16), F.lit(rows[5].p // 16), n, 16, 9)).first()[0] == 5


def test_shards(spark, tmp_path):
    rows = [(i % 40, f"t{i}") for i in range(100)] + [(7, None), (7, ""), (None, "é"), (3, "same"), (3, "same")]
    out = sharding.shard_rows(_docs(spark, rows, extra=True), 16).collect()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(map(len, by.values()))[0] >= max(map(len, by.values())) - 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sharding.shard_rows(_docs(spark, [])).count() == 0
    sharding.write_shards(_docs(spark, [(i, f"t{i}") for i in range(40)]), str(tmp_path / "s"), 4)
    assert sorted(p.name for p in (tmp_path / "s").glob("shard=*")) == [f"shard={k}" for k in range(4)]
    for doubled in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError):
            sharding.write_shards(_docs(spark, doubled), str(tmp_path / "t"), 4)


_SIDE = "file_id long, offset long, length long, record_id long, digest string, finding string, tie string"


def test_fixity(spark):
    def side(rows):
        return spark.createDataFrame([(f, o, n, i, d, "mine", "mine") for f, o, n, i, d in rows], _SIDE)

    digest = lambda x: hashlib.sha256(str(x).encode()).hexdigest()
    own = [(i // 100, i % 100 * 150, 150, i if i % 50 else None, digest(i % 60)) for i in range(300)]
    copy = {row[:2]: row for row in own}
    del copy[(0, 5 * 150)]  # lost
    copy[(0, 77 * 150)] = (0, 77 * 150, 150, 77, digest("x"))  # altered
    copy[(2, 99 * 150)] = (2, 99 * 150, 151, 299, digest(59))  # its length alone differs
    copy[(9, 0)] = (9, 0, *copy.pop((1, 0))[2:])  # moved to another file, its id is null
    copy[(9, 150)] = (9, 150, *copy[(1, 150)][2:])  # one more copy
    found = fixity.audit(side(own), side(list(copy.values())), 4, 600).collect()
    got = sorted((str(r.record_id), r.file_id, r.offset, r.replica_file_id, r.replica_offset, r.finding) for r in found)
    assert got == sorted([
        ("5", 0, 750, None, None, "missing"), ("77", 0, 11550, 0, 11550, "altered"), ("299", 2, 14850, 2, 14850, "altered"),
        ("None", 1, 0, 9, 0, "moved"), ("101", None, None, 9, 150, "extra"),
    ])
    assert fixity.audit(side(own), side(own), 4, 600).count() == 0 and fixity.audit(side([]), side([]), 4).count() == 0
    assert {r.finding for r in fixity.audit(side(own), side([]), 4).collect()} == {"missing"}
    # one record shifted by a byte, with all digests intact
    shifted = [(f, o + (f == 1), n, i, d) for f, o, n, i, d in own]
    assert {(r.file_id, r.finding) for r in fixity.audit(side(own), side(shifted), 4, 600).collect()} == {(1, "moved")}


def test_manifest(spark):
    pages = spark.createDataFrame([(1, "u", "<p>"), (1, "u", "<p>"), (2, None, None), (None, "v", "é" * 100_000)], "page_id long, url string, html string")
    record = fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    places = fixity.manifest(pages.select("page_id", F.octet_length(record).cast("long").alias("length"), F.sha2(record, 256).alias("digest")), ["page_id", "digest"], 3)
    rows = sorted(places.collect(), key=lambda r: r.ordinal)
    assert [r.file_id for r in rows] == [0, 0, 0, 1] and rows[1].offset == rows[0].length > 200_000 and rows[3].offset == 0
