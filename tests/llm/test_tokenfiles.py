"""Token-id files: ids as the tokenizer gives them, round trips, damage, frames read."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinweave.llm import tokenfiles

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\n", "It's we'll  THEY'RE\t'd'", "x\x1cy\x85z w v", "é ́a 가", "ΟΔΟΣ ΣΑΣ. Σ", "a<|endoftext|>b <|startoftext|> <|end", "１２３ 漢字かな", "‍﻿", "y" * 300, "🙂🙂 ok", "İI", "ΑΣ.Α", "ΑΣ.", "ΑΣ)", "x<|endoftext|>.", "end.)!", "...", "a.\"", "don't.", "σİ.", "ÑandÚ:", "\u00d7\u00f7aé"]


def _ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokenfiles.END]


def test_ids_are_those_of_the_tokenizer(monkeypatch):
    tokenizer, made = Tokenizer.from_file(PATH), tokenfiles.encoder(PATH)
    rng = random.Random(5)
    pieces = [*ODD, "the", "Cat's", "\r\n", " ", "naïve", "—", "''", "9.5", "ͅ"]
    texts = ODD + ["".join(rng.choices(pieces + [" ", "\n"], k=rng.randint(1, 30))) for _ in range(400)]
    for part in (1 << 20, 7):
        monkeypatch.setattr(tokenfiles, "PART", part)
        for t in texts:
            assert np.frombuffer(made.ids(t, 2), "<u4").tolist() == _ids(tokenizer, t), t
    monkeypatch.setattr(tokenfiles, "KNOWN", 3)
    assert all(np.frombuffer(made.ids(t, 2), "<u4").tolist() == _ids(tokenizer, t) for t in texts[:50])


def _file(lengths, frame=64):
    rng, out = np.random.default_rng(0), io.BytesIO()
    writer, ids = tokenfiles.Writer(out, frame), []
    for k, n in enumerate(lengths):
        ids.append(rng.integers(0, 1 << 32, n).astype("<u4").tobytes())
        writer.add(None if k == 0 else k, ids[-1])
    writer.close()
    return out.getvalue(), ids


def test_frames_are_independent_and_seekable():
    data, ids = _file([1, 3, 200, 0, 5, 16, 16, 17, 2, 40])
    reader = tokenfiles.Reader(io.BytesIO(data))
    assert [b"".join(reader.ids(k)) for k in range(len(ids))] == ids
    assert reader.documents["null"].tolist() == [1] + [0] * 9
    # any zstandard reader gets all ids
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(ids)
    # one document costs its own frames alone
    for k, frames in ((4, 1), (2, 13), (5, 1), (3, 0)):
        reader = tokenfiles.Reader(io.BytesIO(data))
        assert b"".join(reader.ids(k)) == ids[k] and reader.decompressed == frames
    empty, _ = _file([])
    assert len(tokenfiles.Reader(io.BytesIO(empty)).documents) == 0


def test_damage_is_found():
    data, ids = _file([16] * 20)
    good = tokenfiles.Reader(io.BytesIO(data), "some.zst")
    at = int(good.places[7, 0]) + 20
    broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
    reader = tokenfiles.Reader(io.BytesIO(broken), "some.zst")
    assert b"".join(reader.ids(6)) == ids[6]
    with pytest.raises(ValueError, match="some.zst: frame 7"):
        list(reader.ids(7))
    for cut in (data[:-1], data[:100], b"", b"x" * 40):
        with pytest.raises(ValueError, match="no seek table"):
            tokenfiles.Reader(io.BytesIO(cut))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(["alpha", "Beta,", "don't", "γάμμα", "x1"], k=rng.randint(0, 60)))) for k in rng.sample(range(-500, 5000), 300)]
    rows += [(None, "no id"), (None, None), (7000, None), (7001, ""), (7002, "twice"), (7002, "twice"), (7002, "other"), (7003, "long words " * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name in ("tie", "row", "part", "file", "ids"):
        df = df.withColumn(name, F.lit("mine"))
    manifest = tokenfiles.write_files(df, str(tmp_path / "out"), frame=4096)
    got = sorted(tokenfiles.read_files(manifest, with_ids=True).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(PATH)
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append(np.array(_ids(tokenizer, t), "<u4").tobytes())
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at and bytes(r.ids) in want[r.doc_id] and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        want[r.doc_id].remove(bytes(r.ids))
        at += r.n_tokens
    first = rows[0][0]
    some = tokenfiles.read_files(manifest, wanted=[7002, 7003, first, 99999]).collect()
    assert sorted(r.doc_id for r in some) == [first, 7002, 7002, 7002, 7003]
    assert {(r.start, r.ids_crc32) for r in some} <= {(r.start, r.ids_crc32) for r in got}
    assert manifest.agg(F.sum("n_documents")).first()[0] == len(rows)
    assert tokenfiles.read_files(tokenfiles.write_files(df.limit(0))).count() == 0
