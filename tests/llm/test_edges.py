"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import itertools
import tempfile

import numpy as np
import public_tokenizers
import pytest

from skein.llm import (decontamination, fingerprints, near_dup, packing, pii, quality, sharding,
                       substring_dedup, token_output, url_filter)
from tests.llm import brute

WORDS = [f"w{i}" for i in range(400)]
RNG = np.random.default_rng(7)


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


A, B = prose(120, 1), prose(80, 2)
ROWS = [
    (1, A), (2, A), (3, A + " one more"), (4, B), (5, None), (6, ""), (7, "   \n\t"), (8, "one two three"),
    (9, "One two  three"), (10, prose(3000, 3) + " " + prose(60, 4)), (11, prose(60, 4) + " " + prose(30, 5)),
    (12, B), (12, B), (13, prose(50, 6)), (13, prose(50, 8)), (None, prose(40, 9)), (None, None),
    (14, "é" * 50 + " ünïcode\u2003space  double " + "x" * 5000 + " <|endoftext|> 𝒳𝒴 don't 12345"),
    (15, B[:200].upper()), (16, A.replace("w1", "v1")),
]
CLASH = ("shard int, score double, length int, uid long, pos long, slot int, text string, doc_id long, "
         "sequence_id int, keys binary, __range int, n_chars long")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(0, 0.5, 3, 4, 5, 6, t, d, 7, b"x", 8, -1 if t is None else len(t)) for d, t in ROWS]
    return spark.createDataFrame(rows, CLASH).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASH)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_substring_dedup(docs, none):
    got = substring_dedup.remove_repeats(docs)
    rows = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(brute.repeats(ROWS), key=repr)
    for r in got.collect():  # intervals are maximal: they neither touch nor overlap
        ends = [(i.start, i.end) for i in r.removed]
        assert sum(b - a for a, b in ends) == r.n_removed and all(x[1] < y[0] for x, y in zip(ends, ends[1:]))
    assert substring_dedup.remove_repeats(none).count() == 0
    # more buckets, as a larger input has, change nothing
    assert substring_dedup.bucket_count(none) == 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert substring_dedup.bucket_count(docs, 64) > substring_dedup.bucket_count(docs)
    finer = substring_dedup.remove_repeats(docs, bucket_bytes=64)
    assert sorted(map(str, finer.collect())) == sorted(map(str, got.collect()))


def test_rabin_karp_windows_agree_with_equality():
    words = RNG.integers(0, 3, 2000).astype(np.uint64) + np.uint64(1)
    hashes = substring_dedup.window_hashes(words, 5)
    plain = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    assert len(set(hashes.tolist())) == len(set(plain))
    assert all((hashes[i] == hashes[j]) == (plain[i] == plain[j]) for i, j in RNG.integers(0, len(plain), (3000, 2)))


def test_near_duplicates(docs, none):
    got = near_dup.near_duplicates(docs, 0.8).collect()
    assert len(got) == len(ROWS)
    known = [(d, t) for d, t in ROWS if d is not None and d not in (12, 13)] + [(12, B)]
    want = brute.near_dup(known, 80)
    for r in got:
        if r.doc_id in want:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert [r.component_id for r in got if r.doc_id == 13] == [13, 13] and sum(r.first for r in got if r.doc_id == 13) == 2
    assert sum(r.first for r in got if r.component_id == 4) == 1
    kept = near_dup.drop_near_duplicates(docs, 0.8)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in got if r.first or not r.n_shingles)
    assert ids.count(13) == ids.count(None) == 2 and ids.count(12) == 0
    texts = [r.text for r in kept.collect()]
    assert {prose(50, 6), prose(50, 8)} <= set(texts)  # unlike texts of one doc_id both stay
    assert near_dup.near_duplicates(none).count() == 0 and near_dup.drop_near_duplicates(none).count() == 0


def test_near_duplicates_in_a_large_group(spark):
    """Hundreds of edits of one text, many linked only through others, against all pairs."""
    base, rows = prose(150, 20).split(), []
    for i in range(400):
        words = list(base)
        for at in RNG.choice(150, RNG.integers(0, 6), replace=False):
            words[at] = f"e{RNG.integers(0, 10_000)}"
        rows.append((i + 1, " ".join(words)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 0.85)
    want = brute.near_dup(rows, 85)
    assert len({c for _, c in want.values()}) > 20
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def test_near_duplicates_frees_what_its_steps_leave_on_the_driver(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(near_dup, "free_shuffles", lambda session: freed.append(session), raising=False)
    docs = spark.createDataFrame([(1, A), (2, A + " one more"), (3, B)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert len(freed) >= 3  # after the buckets, the links of the first stars and their components


def test_near_duplicates_that_share_an_id_or_are_whole_copies(spark):
    rows = [(1, prose(60, 31), "x"), (1, prose(60, 32), "y"), (2, prose(60, 33), "z"), (3, prose(60, 34), "b"),
            (3, prose(60, 34), "a"), (4, prose(60, 34) + " end", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    kept = near_dup.drop_near_duplicates(docs)
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [1, 1, 2, 3]
    again = near_dup.drop_near_duplicates(docs.repartition(5))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, again.collect()))


def test_buckets_of_the_same_documents_share_centres(spark):
    """A group that agrees in 35 bands meets as many centres as there are orders, not 35."""
    keys = spark.createDataFrame([(u, k * 7919 - 100_000) for k in range(35) for u in range(60)], "uid long, key long")
    centres = near_dup._centres(keys).collect()
    assert len(centres) == 35 and all(c.n == 60 and 0 <= c.centre < 60 for c in centres)
    assert len({c.centre for c in centres}) <= near_dup.ORDERS
    rows = [(k, u, u) for k in range(35) for u in range(60)]
    pairs = near_dup._next_stars(spark.createDataFrame(rows, "key long, uid long, component long"), 0).count()
    assert pairs <= 60 * near_dup.ORDERS


def test_stars_meet_other_components(spark):
    rows = [(k, u, c) for k in (1, 2) for u, c in ((10, 10), (11, 10), (12, 12), (13, 10), (14, 14))]
    of = {u: c for _, u, c in rows}
    for turn in range(3):
        pairs = near_dup._next_stars(spark.createDataFrame(rows, "key long, uid long, component long"), turn).collect()
        assert all(of[p.a] != of[p.b] for p in pairs) and len(pairs) <= len(rows)
        assert {x for p in pairs for x in p} == set(of)


def test_pairs_below_the_threshold_are_not_confirmed(spark, monkeypatch):
    """Edits of one text that share buckets and are just too unlike: few of all 1,770 pairs are confirmed,
    where the odd sketches alone let most through."""
    base, rows, met, confirm = prose(600, 21).split(), [], [], near_dup._confirm
    for i in range(60):
        words = list(base)
        for at in RNG.choice(119, 9, replace=False):
            words[5 * at + 4] = f"e{i}x{at}"
        rows.append((i + 1, " ".join(words)))

    def counted(pairs, sets, threshold):
        met.append(pairs.count())
        return confirm(pairs, sets, threshold)

    monkeypatch.setattr(near_dup, "_confirm", counted)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.8)
    want = brute.near_dup(rows, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) > 50 and sum(met) < 350


@pytest.mark.parametrize("n", [1, 30, 500, 20_000])
def test_whole_parity_never_counts_more_than_differs(n):
    for differ in (0, 1, n // 9, n):
        shared, own = (np.unique(RNG.integers(0, 1 << 63, k, dtype=np.uint64)) for k in (n, differ))
        xor = near_dup.whole_parity(shared) ^ near_dup.whole_parity(np.union1d(shared, own))
        count = sum(int(x).bit_count() for x in xor.view(np.uint64))
        assert count <= len(np.setdiff1d(own, shared)) and count >= (differ > 0) * min(1, differ % 2)


def test_odd_sketch_estimates_high_similarity():
    hashes, sizes = near_dup.MinHash(1024, 2048), []
    for same in (0.95, 0.9, 0.85):
        n = 2000
        shared = RNG.integers(0, 1 << 63, int(2 * n * same / (1 + same)), dtype=np.uint64)
        one, two = (np.concatenate([shared, RNG.integers(0, 1 << 63, n - len(shared), dtype=np.uint64)]) for _ in "ab")
        xor = hashes.odd(hashes.samples(one)) ^ hashes.odd(hashes.samples(two))
        count = sum(int(x).bit_count() for x in xor.view(np.uint64))
        sizes.append(1 + 2048 / (4 * 1024) * np.log(1 - 2 * count / 2048))
        assert abs(sizes[-1] - same) < 0.06
    assert sizes == sorted(sizes, reverse=True)


def test_leaks(spark, docs, none):
    items = [(1, " ".join(B.split()[10:40])), (2, "one two three"), (2, "one two three"), (3, None), (4, ""),
             (5, prose(40, 99)), (None, A), (6, A.upper() + "!"), (7, "ünïcode")]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontamination.leaks(docs, table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute.leaks(ROWS, items) and len(got) == len({(r.doc_id, r.item_id) for r in got})
    kept = decontamination.decontaminate(docs, table)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == sum(d not in {r.doc_id for r in got} for d, _ in ROWS)
    assert decontamination.leaks(none, table).count() == 0
    assert decontamination.decontaminate(docs, table.limit(0)).count() == len(ROWS)


def test_unlike_texts_of_one_item_and_size_partitions(spark):
    items = [(7, prose(40, 51)), (7, prose(30, 52)), (7, "short words"), (8, prose(1500, 53)), (9, prose(300, 54))]
    rows = [(1, prose(20, 61) + " " + items[0][1]), (2, items[1][1] + " " + prose(15, 62)), (3, "some short words here"),
            (4, prose(200, 63) + " " + items[3][1] + " tail"), (5, items[3][1][:4000]), (6, items[4][1].replace("w1", "v")),
            (7, " ".join(t for _, t in items)), (8, prose(2000, 64))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute.leaks(rows, items) and len(got) == len(brute.leaks(rows, items))
    assert {(1, 7), (2, 7), (3, 7), (4, 8), (7, 7), (7, 8), (7, 9)} <= {(r.doc_id, r.item_id) for r in got}
    plans = [decontamination.class_plan(c, 0.8) for c in range(12)]
    assert plans == sorted(plans) and plans[4] == (16, 3) and plans[-1][0] > 2 * 16 and all(w < n for n, w in plans)


def test_token_files(spark, docs, none):
    folder = tempfile.mkdtemp(prefix="run-") + "/ids"
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_ids(docs, folder, path)
    got = token_output.read_ids(spark, folder).orderBy("start").collect()
    texts = [t for _, t in ROWS]
    want = {(d, tuple(ids)) for (d, _), ids in zip(ROWS, brute.token_ids(texts, "byte_bpe_50k.json", 2))}
    ids = [tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert {(r.doc_id, i) for r, i in zip(got, ids)} == want and len(got) == len(ROWS)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: -1 if d is None else d)
    assert token_output.fetch(spark, folder, 8) == brute.token_ids(["one two three"], "byte_bpe_50k.json", 2)
    assert len(token_output.fetch(spark, folder, 13)) == 2 and token_output.fetch(spark, folder, 99) == []
    empty = tempfile.mkdtemp(prefix="run-") + "/ids"
    token_output.write_ids(none, empty, path)
    assert token_output.read_ids(spark, empty).count() == 0


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(docs, path, capacity=64)
    want = []
    for (d, _), ids in zip(ROWS, brute.token_ids([t for _, t in ROWS], "word_bpe_49k.json", 1)):
        want += [(d, k, at, tuple(ids[at:at + 64])) for k, at in enumerate(range(0, len(ids), 64))]
    got = packing.pack(pieces, 64).collect()
    assert sorted([(r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got], key=repr) == sorted(want, key=repr)
    assert packing.pack(packing.token_pieces(none, path)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_gapless_and_tight(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.choice([7, 30, 64, 4096]))
    lengths = draw.integers(1, capacity + 1, draw.integers(0, 80))
    counts = [(int(n), int(c)) for n, c in zip(*np.unique(lengths, return_counts=True))]
    if seed % 3 == 0:
        counts = [(n, c * 50) for n, c in counts]
    plan = packing.Plan(counts, capacity)
    bins = {}
    for length, rows in plan.table().items():
        done = 0
        for first_rank, n, per, first, at in rows:
            assert first_rank == done
            done += n
            for k in range(n):
                bins.setdefault(first + k // per, []).append((at + k % per * length, length))
        assert done == dict(counts)[length]
    for parts in bins.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    assert set(bins) == set(range(plan.bins)) and plan.bins <= packing.lower_bound(counts, capacity) * 1.4 + 1


def test_urls(spark):
    urls = ["http://A.Example.NET/en/1", "https://example.com/de/2?x=/#y", "no scheme", None, "", "http://net", "http://net/",
            "http://b.org/fr/9.html", "ftp://c.org?q=1", "x://y://z.net/a", "http://notexample.net/en/3", "http://bad.io/spam/5"]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls * 2)] + [(100 + i, f"http://bad.io/spam/{i}", "", "") for i in range(40)]
    rows += [(200 + i, f"http://good.io/ham/{i + 50}", "", "") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    labels = spark.createDataFrame([(i, int(i >= 50), 0) for i in range(90)] + [(None, 0, None), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_filter.judge(pages, labels).collect()}
    assert len(got) == len(rows)
    want = [("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.com", "/de/2", "example.com/de/", "block"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("net", "", None, None),
            ("net", "/", "net/", "block"), ("b.org", "/fr/9.html", "org/fr/", "allow"), ("c.org", "", None, "allow"),
            ("y:", "//z.net/a", None, "allow"), ("notexample.net", "/en/3", "net/", "block"),
            ("bad.io", "/spam/5", None, "block")]
    for i, w in enumerate(want * 2):
        # a bare "net" is left to the mined rules, which may know that suffix from labelled pages
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict if w[3] else None) == w
    assert all(got[100 + i].verdict == "block" and got[200 + i].verdict == "allow" for i in range(40))
    assert url_filter.judge(pages.limit(0), labels).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, labels.limit(0)).where("rule is null").collect()} == {"allow"}


PII = [
    "mail a@b.c_d@e.f, x..y@z-1.co.uk.", "é𝒳 call +1 (212) 555-0199 now", "ip 1.2.3.4.5 and 256.1.1.1, 007.0.0.1 12.34",
    "card 4111 1111 1111 1111 ok", "4111 1111 1111 1112", "nr 12 4111111111111111", "+1 (269) 555-3296 4524132264652876",
    "IBAN GB82 WEST 1234 5698 7654 32 fine", "GB83 WEST 1234 5698 7654 32", "ssn 123-45-6789", "id 123-45-6789",
    "1" * 3000 + " " + "a" * 3000 + "@", "a@b" + ".c" * 3000, "5 5-5 5--5 55 5555-5555 55555555", "+" + "(" * 2000 + "1", "", None,
    "+49 30 901820 and +1.2.3.4.5.6.7.8.9.0.1.2.3.4.5.6 x@y", "1.1.1.1" * 50, "a@b.c" * 40,
]


def test_pii(spark):
    rows = [(i, t, len(t or "")) for i, t in enumerate(PII * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = df.select("doc_id", pii.spans(df.text).alias("s")).collect()
    for r in got:
        text = rows[r.doc_id][1]
        assert [(s.kind, s.start, s.end) for s in r.s if s.base] == brute.base_spans(text), text
    more = {r.doc_id: [(s.kind, rows[r.doc_id][1][s.start:s.end]) for s in r.s if not s.base] for r in got}
    assert more[5] == [("card", "4111111111111111")]
    assert more[6] == [("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    assert more[7] == [("iban", "GB82 WEST 1234 5698 7654 32")] and more[8] == [] and more[10] == []
    assert more[9] == [("national_id", "123-45-6789")]
    clean = pii.redact(df).collect()
    assert [c.n_chars for c in clean] == [None if c.text is None else len(c.text) for c in clean]
    texts = {c.doc_id: c.text for c in clean}
    assert texts[3] == "card <CARD> ok" and texts[6] == "<PHONE> <CARD>" and texts[16] is None and texts[10] == PII[10]
    assert texts[1] == "é𝒳 call <PHONE> now"


def test_fingerprints(spark, docs, none):
    got = fingerprints.compare_with_next(docs).collect()
    rows = list(dict.fromkeys(ROWS[:]))
    assert len(got) == len(ROWS) and len(rows) < len(ROWS)  # also rows that repeat
    unique = {d: t or "" for d, t in ROWS if d not in (None, 13)}
    of = {r.doc_id: r for r in got if r.doc_id in unique}
    order = sorted(unique, reverse=True)
    for d, after in zip(order, order[1:]):
        if 13 in (d - 1, after + 1) and d - after > 1:
            continue
        t, m = unique[d], len(unique[d]) // 3
        assert of[d].edited_text == t[:len(t) - m] + unique[after][:m] and of[d].n_chars == len(t)
    assert of[5].marks == of[6].marks == of[7].marks == [] and of[6].near_next == 1
    assert of[1].marks == of[2].marks and of[2].near_next == 1
    assert len(fingerprints.compare_with_next(docs.where("doc_id = 1")).collect()) == 1
    assert fingerprints.compare_with_next(none).count() == 0


def test_closed_syncmers_depend_on_their_own_words_only(spark):
    from pyspark.sql import functions as F
    rows = [(1, A), (2, prose(33, 50) + " " + A), (3, A + " " + prose(20, 51)), (4, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, s in ((3, 1), (5, 2)):
        got = {r.doc_id: [(x.at, x.hash) for x in r.a] for r in df.select("doc_id", fingerprints.anchors(F.col("text"), k, s).alias("a")).collect()}
        assert {(at + 33, h) for at, h in got[1]} <= set(got[2]) and set(got[1]) <= set(got[3])
        assert 0 < len(got[1]) < 120 and len(got[4]) == 1
    pairs = df.where("doc_id = 2").select(fingerprints.positional_matches(
        fingerprints.anchors(F.lit(A)), fingerprints.anchors(F.col("text"))).alias("m")).first().m
    assert pairs and sum(p.at_b - p.at_a == 33 for p in pairs) > 0.9 * len(pairs)


def test_sharding(docs, none):
    got = sharding.assign(docs, shards=4).collect()
    assert len(got) == len(ROWS)
    size = {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert sum(size.values()) == sum(len((t or "").encode()) + 1 for _, t in ROWS)
    for s in size:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.assign(none).count() == 0
    out = tempfile.mkdtemp(prefix="run-") + "/shards"
    sharding.write_shards(docs.select("doc_id", "text"), out, shards=4)
    assert docs.sparkSession.read.parquet(out).groupBy("shard").count().count() == len(size)


@pytest.mark.parametrize("seed", range(8))
def test_minimax_capacity_is_the_smallest(seed):
    draw = np.random.default_rng(seed)
    sizes, shards = draw.integers(0, 30, draw.integers(1, 12)), int(draw.integers(1, 6))
    capacity, cuts = sharding.minimax_cuts(sizes, shards)

    def needed(limit):
        n, room = 1, limit
        for s in sizes:
            if s > limit:
                return 99
            n, room = (n, room - s) if s <= room else (n + 1, limit - s)
        return n

    assert needed(capacity) <= shards and (capacity == 0 or needed(capacity - 1) > shards or capacity == -(-sizes.sum() // shards))
    assert max(map(sum, np.split(sizes, cuts))) <= capacity
    assert len(cuts) == shards - 1 and cuts == sorted(cuts)


def test_a_large_group_leaves_no_shard_empty():
    """One group of copies holds a third of all bytes: the other shards share the rest evenly."""
    sizes = np.full(3000, 10)
    sizes[1200] = 15_000
    capacity, cuts = sharding.minimax_cuts(sizes, 16)
    parts = sorted(int(p.sum()) for p in np.split(sizes, cuts))
    assert capacity == 15_000 and parts[-1] == 15_000
    assert parts[0] > 1900 and parts[-2] < 2100


@pytest.mark.parametrize("seed", range(20))
def test_cuts_against_every_partition(seed):
    """The largest shard as small, and then the smallest as large, as any contiguous partition has."""
    draw = np.random.default_rng(seed)
    sizes, shards = draw.integers(0, 12, draw.integers(1, 9)), int(draw.integers(1, 5))
    shape = lambda cuts: [int(p.sum()) for p in np.split(sizes, cuts)]
    every = [shape(c) for c in itertools.combinations_with_replacement(range(len(sizes) + 1), shards - 1)]
    got = shape(sharding.minimax_cuts(sizes, shards)[1])
    assert (max(got), -min(got)) == min((max(p), -min(p)) for p in every)


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (8, None), (9, 1), (9, 0)], "doc_id long, quality int")
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(none, labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


@pytest.mark.parametrize("name,kept", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_ids_equal_whole_text_ids(name, kept):
    from skein.llm.bpe import IdEncoder
    draw = np.random.default_rng(3)
    alphabet = list("ab'sé1 2\n\t   \x01|!") + ["don't", " the", "  ", "𝒳", "́", "Σ", "<|endoftext|>", " \n", "\n "]
    texts = ["".join(draw.choice(alphabet, draw.integers(0, 40))) for _ in range(3000)]
    texts += [t or "" for _, t in ROWS] + [" ", "", "a ", " a", "\n", "a  b", "a\n b", "a \nb"]
    plain = brute.tokenizer(name)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    enc = IdEncoder(public_tokenizers.path(name), kept)
    for _ in range(2):
        assert [i.tolist() for part in (texts[:1000], texts[1000:]) for i in enc.encode(part)] == want


def test_a_url_rule_needs_enough_pages(spark):
    """Nine bad pages of a host make no rule; the tenth does, and a rule no surer than a shorter one goes."""
    schema = "page_id long, url string"
    labels = spark.createDataFrame([(i, int(i >= 20)) for i in range(60)], "doc_id long, quality int").selectExpr("*", "0 AS toxic")
    good = [(100 + i, f"http://fine.io/a/{i + 20}") for i in range(40)]
    for n in (url_filter.MIN_URLS - 1, url_filter.MIN_URLS):
        bad = [(i, f"http://worse.biz/x/{i}") for i in range(n)]
        got = url_filter.judge(spark.createDataFrame(good + bad + [(300, "http://worse.biz/y/new")], schema), labels).collect()
        want = "block" if n >= url_filter.MIN_URLS else "allow"
        assert {r.verdict for r in got if r.host == "worse.biz"} == {want}
        assert {r.verdict for r in got if r.host == "fine.io"} == {"allow"}


def test_a_url_rule_holds_however_many_pages_there_are(spark):
    """Ten bad pages of a host make a rule among 40 and among 8,000 other pages; toxic labels count without a quality."""
    from pyspark.sql import functions as F
    bad = spark.createDataFrame([(i, f"http://worse.biz/x/{i}") for i in range(10)] + [(90, "http://worse.biz/y/new")],
                                "page_id long, url string")
    for n in (40, 8000):
        ids = spark.range(100, 100 + n)
        good = ids.select(F.col("id").alias("page_id"), F.format_string("http://fine%d.io/a/%d", F.col("id") % 50, "id").alias("url"))
        labels = ids.selectExpr("id AS doc_id", "CAST(id % 5 > 0 AS INT) AS quality", "0 AS toxic").unionByName(
            spark.range(10).selectExpr("id AS doc_id", "CAST(NULL AS INT) AS quality", "1 AS toxic"))
        got = url_filter.judge(bad.unionByName(good), labels).collect()
        assert {r.verdict for r in got if r.host == "worse.biz"} == {"block"}


def test_url_rules_are_those_of_all_token_sets(spark):
    rng, rows = np.random.default_rng(11), []
    for _ in range(600):
        has = [t for t, p in zip("abcdef", (0.5, 0.4, 0.3, 0.3, 0.2, 1)) if rng.random() < p]
        has += ["a2"] * ("a" in has) + ["b2"] * ("b" in has and rng.random() < 0.9)
        rows.append((has, bool(rng.random() < 0.1 + 0.5 * ("a" in has and "c" in has) + 0.4 * ("d" in has and "e" in has))))
    share, sets = sum(b for _, b in rows) / len(rows), {}
    for has, b in rows:
        for k in range(1, len(has) + 1):
            for s in itertools.combinations(sorted(has), k):
                n = sets.setdefault(s, [0, 0])
                n[0] += 1
                n[1] += b
    sure = {}
    for s, (n, b) in sets.items():
        c = b / n
        if b >= 10 and c >= 0.5 and c > share:
            other = (1 - c) * np.log((1 - c) / (1 - share)) if c < 1 else 0
            if np.exp(-n * (c * np.log(c / share) + other)) <= url_filter.CHANCE:
                sure[s] = c
    want = {s: c for s, c in sure.items() if not any(sure.get(s[:i] + s[i + 1:], 0) >= c for i in range(len(s)))}
    got = {tuple(r.tokens): r.confidence for r in url_filter.mine_rules(
        spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()}
    assert len(want) > 3 and max(map(len, want)) > 2 and got == pytest.approx(want)


def test_many_tokens_of_the_same_pages_are_one_set(spark):
    """Thirty tokens that always come together are thirty rules, not their two to the thirtieth combinations."""
    rows = [([f"t{i:02}" for i in range(30)] + [f"u{k % 2}"], k % 10 > 0) for k in range(20)] + [(["v"], False)] * 60
    got = url_filter.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert {tuple(r.tokens) for r in got} >= {(f"t{i:02}",) for i in range(30)} and len(got) < 100


def test_every_path_segment_is_a_url_token(spark):
    """A bad section is found at any depth, and where its name holds digits."""
    bad = ["http://h{}.io/en/shop/casino/{}", "http://h{}.io/top10-pills/{}", "http://h{}.io/a/b/c/d/x1y22/{}.html"]
    rows = [(12 * k + i, u.format(i % 3, 12 * k + i)) for k, u in enumerate(bad) for i in range(12)]
    rows += [(100 + i, f"http://h{i % 3}.io/en/shop/a/b/c/d/toys/{100 + i}") for i in range(60)]
    rows += [(200 + k, u.format("new", "none")) for k, u in enumerate(bad)] + [(210, "http://hnew.io/en/shop/toys/none")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 36), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, labels).collect()}
    assert [i for i, v in sorted(got.items()) if v == "block"] == [*range(36), 200, 201, 202]


def test_short_texts_have_a_fingerprint(spark):
    """Of three words the middle one may have the smallest hash, so that no syncmer is chosen."""
    from pyspark.sql import functions as F
    rows = [(i, f"a{i} b{i} c{i}") for i in range(300)] + [(300, "x" * 40), (301, " ")]
    rows += [(400 + i, " ".join(f"{w}{i}" for w in "abcdefg")) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, s in ((3, 1), (5, 2)):
        got = {r.doc_id: r.f for r in df.select("doc_id", fingerprints.as_text(fingerprints.marks(F.col("text"), k, s)).alias("f")).collect()}
        assert got.pop(301) == "" and all(got.values()) and len(set(got.values())) == len(got)
    near = fingerprints.compare_with_next(df.where("doc_id < 300")).collect()
    assert len(near) == 300 and {r.near_next for r in near} == {0.0}


def test_likeness_of_long_texts_is_exact(spark):
    """One word of twenty thousand is seen, and the likeness is that of the whole sets of anchors."""
    from pyspark.sql import functions as F
    words = [f"w{i}" for i in RNG.integers(0, 1 << 40, 20_000)]
    other = words[:9_000] + ["other"] + words[9_001:]
    rows = [(3, " ".join(words)), (2, " ".join(other)), (1, " ".join(words[:5_000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.compare_with_next(df).collect()}
    assert got[3].marks != got[2].marks and len(got[3].marks) > 10_000
    for d, after in ((3, 2), (2, 1), (1, 3)):
        assert got[d].near_next == len(set(got[d].marks) & set(got[after].marks)) / len(set(got[d].marks) | set(got[after].marks))
    assert 0.999 < got[3].near_next < 1 and got[2].near_next < 0.3 and 0.4 < got[2].near_edited < 1


@pytest.mark.parametrize("same", [0.6, 0.8, 0.85, 0.95])
def test_sketch_cut_keeps_six_deviations_at_every_threshold(same):
    for samples, bits in ((near_dup.bands_for(same) * near_dup.BAND_ROWS, near_dup.COARSE[1]), near_dup.FINE[:2]):
        differ = RNG.binomial(samples, 1 - same, 4000)
        counts = np.array([(np.bincount(RNG.integers(0, bits, 2 * n), minlength=bits) & 1).sum() for n in differ])
        cut = near_dup.sketch_cut(same, samples, bits)
        assert cut >= counts.mean() + 5.7 * counts.std() and cut <= counts.mean() + 6.4 * counts.std() + 1


def test_rows_without_an_id_are_judged_one_by_one(spark):
    rows = [(1, A), (None, A), (None, prose(60, 70)), (None, prose(60, 70)), (None, prose(60, 70) + " end"),
            (None, prose(60, 71)), (None, None), (None, ""), (2, B)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = near_dup.drop_near_duplicates(df, 0.8)
    texts = [r.text for r in kept.collect() if r.doc_id is None]
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.where("doc_id > 0").collect()) == [1, 2]
    assert len(texts) == 4 and {None, "", prose(60, 71)} < set(texts)
    items = spark.createDataFrame([(1, " ".join(prose(60, 71).split()[5:50])), (2, B)], "item_id long, text string")
    clean = [(r.doc_id, r.text) for r in decontamination.decontaminate(df, items).collect()]
    assert sorted(clean, key=repr) == sorted((r for r in rows if r[1] not in (prose(60, 71), B)), key=repr)
