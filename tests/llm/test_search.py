"""Ranked search, filter audit and streaming dedup against plain versions, and their edge cases."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row

from skein.llm import exact_dedup, filter_audit, lexical_search

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = [f"w{i}" for i in range(60)] + ["É", "é", "naïve", "x²", "Zeta", "ZETA"]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


ROWS = [(i, prose(3 + i % 70, i)) for i in range(200)]
ROWS += [(300, None), (301, ""), (302, " .,;\n"), (303, prose(20_000, 9)), (304, prose(30, 4)), (304, prose(31, 5)),
         (None, prose(25, 6)), (None, None), (305, ROWS[7][1]), (306, ROWS[7][1]), (307, "x²-É_é/Zeta zeta ZETA"),
         (308, "only here"), (309, "tie one"), (310, "tie two")]
ITEMS = [(1, prose(12, 77)), (2, "w1 w1 w2, É"), (3, None), (4, "..."), (5, "nowhere atall"), (None, "zeta w3"),
         (7, "only"), (7, "w5 w6"), (8, "tie"), (9, ROWS[7][1])]


def lower(text):
    return re.sub("[A-Z]", lambda c: c.group().lower(), text)


def ranked(rows, items, k=10):
    held = [(d, Counter(map(lower, SPLIT.findall(t or "")))) for d, t in rows]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        wanted = set(map(lower, SPLIT.findall(text or "")))
        scored = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, 0.5, 7, t, 1, "x") for i, t in ROWS],
                                 "doc_id long, score double, n int, text string, rank int, terms string").repartition(5)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, 3) for i, t in ITEMS], "item_id long, text string, query int")


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_brute_force(docs, items):
    assert got(lexical_search.search_documents(docs, items)) == ranked(ROWS, ITEMS)


@pytest.mark.parametrize("room, block_terms, k", [(1, 100_000, 10), (8, 3, 2), (4, 20, 1)])
def test_search_with_crowded_sketches_small_blocks_and_other_k(docs, items, monkeypatch, room, block_terms, k):
    monkeypatch.setattr(lexical_search, "LEAST_WIDTH", 8)
    found = lexical_search.search(lexical_search.build_index(docs, room), items, k, block_terms)
    assert got(found) == ranked(ROWS, ITEMS, k)


def test_search_of_empty_tables(docs, items):
    assert got(lexical_search.search_documents(docs.limit(0), items)) == []
    assert got(lexical_search.search_documents(docs, items.limit(0))) == []
    assert got(lexical_search.search_documents(docs.where("text IS NULL"), items)) == []


def test_counts_beyond_the_sketch_are_bounded(spark):
    rows = [(1, "many " * 70_000 + "rest " * 5), (2, "many rest"), (3, "other")]
    found = lexical_search.search_documents(spark.createDataFrame(rows, "doc_id long, text string"),
                                            spark.createDataFrame([(1, "many rest")], "item_id long, text string"))
    assert got(found) == ranked(rows, [(1, "many rest")])


@pytest.mark.parametrize("width", [8, 256])
def test_bounds_hold_and_few_documents_are_rescored(width):
    rng = np.random.default_rng(3)
    names = [b"t%d" % i for i in range(3000)]
    held = [Counter(names[i] for i in (rng.random(60) ** 3 * 3000).astype(int)) for _ in range(400)]
    df = Counter(t for c in held for t in c)
    rows = [Row(query=q, terms=[names[i] for i in rng.choice(300, 12, False)]) for q in range(8)]
    block = lexical_search.Block(rows, df, len(held))
    n = np.array([sum(c.values()) for c in held])
    sketches = np.zeros((len(held), width), dtype=np.uint8)
    for sketch, c in zip(sketches, held):
        np.maximum.at(sketch, lexical_search.coordinates(c, len(c)) % width, np.fromiter(c.values(), np.uint8, len(c)))
    search = lexical_search.Searcher(block, len(held), int(n.sum()), 3)
    m = lexical_search.length_norm(n, len(held), int(n.sum()))
    scores = np.array([[sum(lexical_search.weight(len(held), df[t]) * lexical_search.impact(c[t], int(md))
                            for t in row.terms if c[t]) for row in rows] for c, md in zip(held, m)])
    assert (search.bounds(sketches, m) >= scores).all()
    search.take(list(range(400)), n, [b" ".join(c) for c in held],
                [np.fromiter(c.values(), "<u4", len(c)).tobytes() for c in held], sketches)
    for q, mine in enumerate(search.kept):
        assert sorted(mine.rows)[:3] == sorted((-int(s), False, d) for d, s in enumerate(scores[:, q]) if s)[:3]
    assert width == 8 or search.rescored < scores.size / 2
    assert (np.diff(lexical_search.impact(np.arange(1, 5000), int(m[2]))) >= 0).all()


def test_terms():
    text = "Don't x²-É_é/ZETA\x00a\x7fb\x80c ١٢ 9z"
    assert [t.decode() for t in lexical_search.terms(text)] == [lower(t) for t in SPLIT.findall(text)]
    assert lexical_search.terms(None) == []


# --- filter audit

LONG = " ".join(f"t{i}" for i in range(220))
AUDIT = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "fr"), (4, "short words", "en"), (5, "a a a a a", "en"),
    (6, "LOUD TEXT", "fr"), (7, "money $ here", None), (8, None, "en"), (9, "", "en"), (10, None, ""),
    (11, LONG.replace("t5 ", "$ "), "de"), (12, "rep " * 300, "en"), (13, "rep " * 300, "en"), (13, "rep " * 300, "en"),
    (None, LONG, "en"), (None, "x", None), (14, " \t ", "en"), (15, "É" * 40 + " A", "fr"), (16, "word two " * 3, "de"),
    (17, "x " * 20_000, "de"),
]
MARKS = [(1, 1, 0), (2, 1, 0), (2, 0, 1), (4, 0, 1), (6, 1, 1), (9, None, None), (13, 1, 0), (99, 1, 1), (None, 1, 1), (11, 1, 0)]


def brute_audit(rows, marks):
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good = {d for d, q, _ in marks if q == 1 and d is not None}
    toxic = {d for d, _, t in marks if t == 1 and d is not None}
    docs = []
    for d, t, part in rows:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": d is not None and t in least and d > least[t]}
        docs.append((part or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out, shapley = [], defaultdict(int)
    for part in {p for p, *_ in docs}:
        mine = [x for x in docs if x[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                            sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone), f))
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def test_audit_equals_brute_force_and_empty_table(spark):
    docs = spark.createDataFrame([(d, t, p, 5, 6) for d, t, p in AUDIT],
                                 "doc_id long, text string, lang string, mask int, good int").repartition(4)
    labels = spark.createDataFrame([(*m, 1) for m in MARKS], "doc_id long, quality int, toxic int, part int")
    assert sorted(map(tuple, filter_audit.audit(docs, labels).collect())) == brute_audit(AUDIT, MARKS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    unlabelled = filter_audit.audit(docs, labels.limit(0)).collect()
    assert sorted(map(tuple, unlabelled)) == brute_audit(AUDIT, [])


@pytest.mark.parametrize("n", [1, 3, 6])
def test_gray_code_walk_equals_direct_counts(n):
    rng = np.random.default_rng(n)
    mask, totals = rng.integers(0, 1 << n, 40), rng.integers(0, 9, (40, 3))
    states = filter_audit.walk(mask, totals, n)
    for subset in range(1 << n):
        assert (states[subset] == totals[mask & subset == 0].sum(axis=0)).all()
    steps = filter_audit.steps(mask, totals, "ABCDEF"[:n])
    assert isinstance(steps, pd.DataFrame) and len(steps) == math.factorial(n) * n
    # an order removes as many as fail any filter, whatever its sequence
    assert set(steps.groupby("filter_order")["removed"].sum()) == {int(totals[mask > 0, 0].sum())}


# --- exact dedup

COPIES = [(5, "a b c"), (3, "abc"), (9, "a  b  c"), (8, "a b c  "), (1, None), (2, ""), (4, " \n\t\x0b\x0c\r"), (6, "x"), (6, "x"),
          (None, "x "), (None, "only null"), (7, "a b c"), (10, "é" * 30_000), (11, "é" * 30_000), (12, "Abc")]
COPIES += [(100 + i, "hot  " + " " * (i % 3) + "copy") for i in range(300)]


def brute_copies(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((d, len(t or "")))
    out = []
    for t, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        sha, one = hashlib.sha256(t.encode()).hexdigest(), False
        for d, n in members:
            kept = (d, n) == keep and not one
            one |= kept
            out.append((d, keep[0], len(members), kept, sha))
    return sorted(out, key=repr)


def stored(spark, tmp_path, rows, parts=4, name="documents.parquet"):
    path = str(tmp_path / name)
    (spark.createDataFrame([(1, d, t, 2) for d, t in rows], "digest int, doc_id long, text string, row int")
     .repartition(parts).write.mode("append").parquet(path))
    return path


def result(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("bits", [256, 8])
def test_dedup_equals_brute_force_also_when_digests_collide(spark, tmp_path, bits):
    path = stored(spark, tmp_path, COPIES)
    assert result(exact_dedup.deduplicate(spark, path, bits=bits)) == brute_copies(COPIES)


def test_dedup_of_an_empty_table_and_of_one_file(spark, tmp_path):
    empty = stored(spark, tmp_path, [], 1, "empty.parquet")
    assert result(exact_dedup.deduplicate(spark, empty)) == []
    folder = stored(spark, tmp_path, COPIES[:6], 1, "folder")
    one = next(str(p) for p in (tmp_path / "folder").glob("part-*.parquet"))
    assert folder and result(exact_dedup.deduplicate(spark, one)) == brute_copies(COPIES[:6])


def test_state_outlives_the_stream_and_takes_later_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    path, folder = stored(spark, tmp_path, COPIES[:8], 2), str(tmp_path / "state")
    first = exact_dedup.deduplicate(spark, path, folder, files_per_batch=1)
    assert result(first) == brute_copies(COPIES[:8])
    stored(spark, tmp_path, COPIES[8:], 2)  # more files come; only they are streamed
    assert result(exact_dedup.deduplicate(spark, path, folder, files_per_batch=1)) == brute_copies(COPIES)
    held = exact_dedup.held(spark, folder)
    assert {"digest", "keep_id", "keep_at", "group_size"} <= set(held.columns)
    assert held.count() == len({r[4] for r in brute_copies(COPIES)})
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
