"""The registered queries against plain Python versions, on whole small tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from skein.llm import queries as Q
from skein.llm.packing import lower_bound
from tests.conftest import SF_SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def test_op1_matches_containment(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in Q.op1_decontamination(spark, SF_SMALL).collect()}
    assert got == brute.leaks(docs, items)
    assert {(d, i) for d, t in docs for i, x in items if x in t} <= got


def test_op2_round_trip(spark, docs):
    ordered = sorted(docs)
    want, start = [], 0
    for (doc_id, _), ids in zip(ordered, brute.token_ids([t for _, t in ordered], "byte_bpe_50k.json", 2)):
        want.append((doc_id, start, len(ids), brute.crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, Q.op2_token_output(spark, SF_SMALL).collect())) == want


def test_op3_pieces_and_bins(spark, docs):
    got = Q.op3_packing(spark, SF_SMALL).collect()
    want = set()
    for (doc_id, _), ids in zip(docs, brute.token_ids([t for _, t in docs], "word_bpe_49k.json", 1)):
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want.add((doc_id, k, at, len(part), brute.crc(part)))
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    least = lower_bound([(r.length, 1) for r in got], 4096)
    assert len(bins) <= least * 1.02 + 1


def test_op4_fixed_rules(spark):
    rows = {r.page_id: r for r in Q.op4_url_filter(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(rows) == len(pages)
    rules = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/"))
    for p in pages:
        host, _, rest = p.url.split("://", 1)[1].partition("/")
        path = ("/" + rest).split("?")[0].split("#")[0]
        fit = [(len(h + x), h + x, v) for v, h, x in rules
               if (host == h or host.endswith("." + h)) and path.startswith(x)]
        r = rows[p.page_id]
        assert (r.host, r.path) == (host, path)
        if fit:
            assert (r.rule, r.verdict) == max(fit)[1:]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_op5_base_spans(spark, docs):
    texts = dict(docs)
    for r in Q.op5_pii(spark, SF_SMALL).collect():
        base = brute.base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == x for x, _, _ in base) for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_op6_edits_and_likeness(spark, docs):
    order = sorted(docs, reverse=True)
    following = {d: order[(k + 1) % len(order)] for k, (d, _) in enumerate(order)}
    got = {r.doc_id: r for r in Q.op6_fingerprints(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for d, t in docs:
        r, m = got[d], len(t) // 3
        edited = t[:len(t) - m] + following[d][1][:m]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if following[d][1] == t:
            assert r.near_next == 1
        # the likeness comes from the two fingerprint columns and nothing else
        one, two, after = (set(re.findall(".{8}", f)) for f in (r.fingerprint, r.edited_fingerprint, got[following[d][0]].fingerprint))
        assert r.near_edited == (len(one & two) / len(one | two) if one | two else 1.0)
        assert r.near_next == (len(one & after) / len(one | after) if one | after else 1.0)
    long = [r for r in got.values() if r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next + 0.1 for r in long if r.near_next < 0.5]) > 0.98


def test_op7_components(spark, docs):
    want = brute.near_dup(docs, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in Q.op7_near_dup(spark, SF_SMALL).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_op8_shards(spark, docs):
    got = Q.op8_sharding(spark, SF_SMALL).collect()
    texts = dict(docs)
    of_text, sizes, slots = {}, [0] * 16, {}
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert of_text.setdefault(texts[r.doc_id], r.shard) == r.shard
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for r in got:
        groups[texts[r.doc_id]] = groups.get(texts[r.doc_id], 0) + r.size
    assert max(sizes) <= sum(sizes) / 16 + max(groups.values())


def test_op9_repeats(spark, docs):
    got = sorted(map(tuple, Q.op9_substring_dedup(spark, SF_SMALL).collect()))
    assert got == sorted(brute.repeats(docs))
    assert any(n for _, _, n, _ in got)


def test_op10_scores(spark, docs):
    got = {r.doc_id: r for r in Q.op10_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    unseen = [(got[d].predicted, q) for d, q in labels.items() if d in got and got[d].held_out]
    assert np.mean([p == q for p, q in unseen]) > 0.9


def test_tokenizer_files_are_read_in_place():
    assert public_tokenizers.path("byte_bpe_50k.json").startswith("/opt/")
