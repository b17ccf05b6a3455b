"""Encoders and packing against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, transducer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_bpe_equals_tiktoken_and_round_trips(docs, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: r for r in bpe.encode_texts(docs, RANKS).collect()}
    digests = {r["doc_id"]: r for r in bpe.digest_texts(docs, RANKS).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert found[i]["ids"] == ids
        assert bytes(found[i]["decoded"]) == (text or "").encode()
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    table = bpe.MinimalPerfectHash(keys)
    assert sorted(table.index_of_build_keys) == list(range(5000))
    assert (table.lookup(keys) == table.index_of_build_keys).all()


def test_transducer_counts_equal_the_library(docs, texts):
    library = Tokenizer.from_file(WORDS)
    found = {r["doc_id"]: r for r in transducer.count_tokens(docs, WORDS).collect()}
    for i, text in enumerate(texts):
        assert found[i]["n_tokens"] == len(library.encode(text or "", add_special_tokens=False).ids), text
        assert found[i]["n_bytes"] == len((text or "").encode())


def test_transducer_chunks_compose(monkeypatch):
    text = "some words " * 50 + "unbrokenwordwithoutend" * 40
    whole = transducer.count_texts([text], WORDS)[0]
    for size in (1, 3, 17):
        monkeypatch.setattr(transducer, "CHUNK", size)
        assert transducer.count_texts([text], WORDS)[0] == whole


def _words(n):
    draw = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789.,-+" + "\u00e4\u00f6\u0434\u043e\u4e2d\u6587\u65e5\u0627\u0644\u03b1\u03b2\u0e01\u0e02\u0905\u0906"))
    return ["".join(draw.choice(letters, draw.integers(2, 12))) for _ in range(n)]


def test_transducer_tables_hold_transitions_and_not_all_bytes_of_every_state():
    model = transducer.Transducer(transducer.Merges(WORDS))
    model.counts([" ".join(_words(4000))])
    assert len(model.states) > 4000
    held = sum(x.nbytes for x in vars(model).values() if isinstance(x, np.ndarray))
    assert held <= 256 * len(model.states)


def test_transducer_that_starts_anew_counts_the_same(monkeypatch):
    texts = [" ".join(_words(60)[i:]) for i in range(0, 60, 7)]
    library = Tokenizer.from_file(WORDS)
    monkeypatch.setattr(transducer, "MAX_STATES", 100)
    monkeypatch.setattr(transducer, "MAX_PAIRS", 20)
    model = transducer.Transducer(transducer.Merges(WORDS))
    for text in texts:
        assert model.counts([text])[0] == len(library.encode(text, add_special_tokens=False).ids)
        model._clear()
        assert len(model.states) == 2 and model.merges.pairs() <= 20


def test_packing_covers_every_id_once(spark, docs, texts):
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack(spark, packing.cut_documents(docs, WORDS, 1)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert len(by_doc) == len(texts)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_plan_packs_the_histogram_within_the_bound():
    histogram = {60: 500, 90: 300, 120: 400, 7: 900, 256: 3}
    plan = packing.plan_patterns(histogram, 256)
    used: dict[int, int] = {}
    for pattern, times in plan:
        assert sum(k * c for k, c in pattern.items()) <= 256
        for k, c in pattern.items():
            used[k] = used.get(k, 0) + c * times
    assert used == histogram
    least = sum(k * n for k, n in histogram.items()) / 256
    assert sum(times for _, times in plan) <= 1.05 * least + 2


def test_empty_tables(spark, none):
    assert bpe.digest_texts(none, RANKS).count() == 0
    assert transducer.count_tokens(none, WORDS).count() == 0
    assert packing.pack(spark, packing.cut_documents(none, WORDS, 1)).count() == 0
