"""Piecewise hashes, spelling variants and the filter audit: brute force, odd and empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import LONG, ODD, documents
from lotledger.llm import filter_audit, piecewise_hash, spelling_variants
from lotledger.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def edits(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(line[j + 1] + 1, now[-1] + 1, line[j] + (x != y)))
        line = now
    return line[-1]


# --- piecewise hashes -------------------------------------------------------------------

BITS = (1 << 64) - 1


def plain_fingerprint(data):
    """The same rule, byte by byte and over the whole text at once."""
    if not data:
        return "1:"
    padded, hashes = bytes(6) + data, []
    for i in range(len(data)):
        h = 0
        for byte in padded[i: i + 7]:
            h = (h * 0x9E3779B97F4A7C15 + byte) & BITS
        h ^= h >> 29
        h = h * 0xBF58476D1CE4E5B9 & BITS
        hashes.append(h ^ h >> 32)
    ones = [len(bin(h)) - len(bin(h).rstrip("1")) if h else 0 for h in hashes]
    k = next(k for k in range(65) if sum(o >= k for o in ones) <= 64)
    signatures = []
    for level in range(k, k + 3):
        letters, total = "", 0
        for i, (h, o) in enumerate(zip(hashes, ones)):
            total = (total + h) & BITS
            if o >= level or i == len(hashes) - 1:
                letters += chr(piecewise_hash.LETTERS[(total * 0xBF58476D1CE4E5B9 & BITS) >> 58])
                total = 0
        signatures.append(letters)
    return ":".join([str(1 << k), *signatures])


def plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = (
        {int(m.split(":")[0]) << i: s for i, s in enumerate(m.split(":")[1:]) if s} for m in (a, b)
    )
    best = 0.0
    for size in sorted(x.keys() & y.keys())[:2]:
        p, q = x[size], y[size]
        run = min(3, len(p), len(q))
        if {p[i: i + run] for i in range(len(p) - run + 1)} & {q[i: i + run] for i in range(len(q) - run + 1)}:
            best = max(best, 1 - edits(p, q) / max(len(p), len(q)))
    return best


def plain_neighbours(rows):
    """Rows of (doc_id, text) in order of id (null first), with their next."""
    rows, out = [(i, t or "") for i, t in rows], []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        changed = (text[: len(text) - cut] + after[:cut]).encode()
        mine, other, last = (plain_fingerprint(x) for x in (text.encode(), changed, after.encode()))
        out.append((
            i, len(text), hashlib.sha256(changed).hexdigest(), mine, other,
            round(plain_likeness(mine, other), 12), round(plain_likeness(mine, last), 12),
        ))
    return sorted(out, key=repr)


def got_neighbours(df):
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.collect()), key=repr)


def test_fingerprints_equal_a_plain_version():
    rng = random.Random(5)
    texts = [b"", b"a", b"ab" * 3000, bytes(70), bytes(rng.choices(range(256), k=40_000))]
    texts += [" ".join(rng.choices(["ein", "zwei", "größer", "x"], k=rng.randint(1, 400))).encode() for _ in range(60)]
    for text in texts:
        assert piecewise_hash.fingerprint(text) == plain_fingerprint(text)


def test_blocks_do_not_show(monkeypatch):
    data = bytes(random.Random(6).choices(b"abcdefgh ", k=30_000))
    whole = piecewise_hash.fingerprint(data)
    monkeypatch.setattr(piecewise_hash, "BLOCK", 100)
    assert piecewise_hash.fingerprint(data) == whole


def test_edit_distances():
    rng = random.Random(7)
    a, b = ([bytes(rng.choices(b"abc", k=rng.randint(0, 65))) for _ in range(200)] for _ in range(2))
    assert piecewise_hash.edit_distances(a, b).tolist() == [edits(x, y) for x, y in zip(a, b)]
    assert piecewise_hash.edit_distances([], []).tolist() == []


def test_op11_against_plain(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op11_piecewise_hash"](spark, SF)
    assert got_neighbours(got) == plain_neighbours([tuple(r) for r in rows])
    near = got.agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert near[0] > 0.7 and near[1] < 0.1


def test_op11_odd_rows(spark, odd, none):
    shared = [r for r in ODD if r[0] not in (10, None)]
    want = plain_neighbours(sorted((i, t) for i, t, *_ in shared if i not in (8, 9)))
    few = documents(spark, [r for r in shared if r[0] not in (8, 9)])
    assert got_neighbours(piecewise_hash.with_neighbours(few)) == want
    rows = piecewise_hash.with_neighbours(odd).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in ODD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == "1:" and by_id[1]["near_next"] == 1.0
    assert by_id[8]["near_edited"] > 0.5 and by_id[8]["n_chars"] == len(LONG)
    assert by_id[None]["edited_sha256"] and by_id[11]["near_next"] == 0.0
    assert piecewise_hash.with_neighbours(none).count() == 0
    one = piecewise_hash.with_neighbours(documents(spark, [(4, "all alone here", "en", "a")])).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(4, 1.0)]
    named = piecewise_hash.fingerprints(odd.withColumn("fingerprint", F.lit(1)))
    assert {r["_fingerprint"] for r in named.filter("text is null").collect()} == {"1:"}


def test_op11_a_hot_id(spark):
    rows = [(7, f"text number {i} of one id with some words", "en", "a") for i in range(300)]
    rows += [(i + 10, f"other {i}", "en", "a") for i in range(50)]
    got = piecewise_hash.with_neighbours(documents(spark, rows).repartition(13)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    last = next(r for r in got if r["doc_id"] == 58)  # followed by "other 49"
    assert last["edited_sha256"] == hashlib.sha256(b"other ot").hexdigest()


# --- spelling variants ------------------------------------------------------------------

LETTER = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in LETTER.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    """Words that share a deletion, compared one by one."""
    shelves = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            shelves.setdefault(key, []).append(w)
    near = {w: set() for w in words}
    for shelf in shelves.values():
        for a, b in itertools.combinations(shelf, 2):
            if b not in near[a] and edits(a, b) == 1:
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def got_variants(df):
    return sorted(tuple(r) for r in df.collect())


def test_op12_against_plain(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = plain_variants(plain_words([tuple(r) for r in rows]))
    got = QUERIES["op12_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got_variants(got) == want
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


@pytest.mark.parametrize("slices", [4096, 7])
def test_op12_large_blocks_and_odd_words(spark, monkeypatch, slices):
    """Anagrams and words over few letters fill single blocks; very long words stand beside them."""
    monkeypatch.setattr(spelling_variants, "SLICE", slices)
    monkeypatch.setattr(spelling_variants, "TILE", 16)
    rng = random.Random(8)
    words = ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(250)]
    words += ["z" * 5, "z" * 6, "z" * 7, "q" * 300, "q" * 299 + "r", "q" * 301, "ÀÀÀÀà", "ÀÀÀÀÀ", "×÷×÷×", "×÷×÷"]
    rows = [(i, " ".join(rng.choices(words, k=60)) + " " + " ".join(words), "en", "a") for i in range(12)]
    want = plain_variants(plain_words([(i, t) for i, t, *_ in rows]))
    assert got_variants(spelling_variants.variants(documents(spark, rows))) == want


def test_op12_odd_and_empty(spark, odd, none):
    want = plain_variants(plain_words([(i, t) for i, t, *_ in ODD]))
    assert got_variants(spelling_variants.variants(odd)) == want
    assert spelling_variants.variants(none).count() == 0
    assert spelling_variants.variants(documents(spark, [(1, None, None, None), (2, "one two", None, None)])).count() == 0


def test_op12_chains_of_forms(spark):
    forms = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", None), ("x", "e"), ("y", None)]
    got = spelling_variants.roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert {tuple(r) for r in got} == {(w, "e") for w in "abcdx"}


def test_op12_sends_no_table_through_the_driver(spark, monkeypatch):
    """Tables that grow with the words are merged, however small Spark takes them to be."""
    plans = []

    def settled(df, name):
        plans.append(df)
        return written(df, name)

    written = spelling_variants.settled
    monkeypatch.setattr(spelling_variants, "settled", settled)
    text = "paris " * 9 + "pariss " * 4 + "parisss berlin berlin berlim "
    rows = [(i, text, "en", "a") for i in range(4)]
    got = spelling_variants.variants(documents(spark, rows))
    want = plain_variants(plain_words([(i, t) for i, t, *_ in rows]))
    assert got_variants(got) == want and ("parisss", "pariss", "paris") in {w[:3] for w in want}
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, got]]
    assert sum("SortMergeJoin" in plan for plan in plans) >= 3
    assert not any("Broadcast" in plan for plan in plans)


# --- filter audit -----------------------------------------------------------------------

def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, _, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": bool(set(text) & set("#$%&*|")), "E": i is not None and least[text] < i,
        }
        parts.setdefault(source or "", []).append((fails, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        orders = ["".join(o) for o in itertools.permutations("ABCDE")]
        gone = {}
        for order in orders:
            alive = list(rows)
            for step, name in enumerate(order, 1):
                lost = [r for r in alive if r[0][name]]
                alive = [r for r in alive if not r[0][name]]
                gone[order, step] = (
                    part, order, step, len(alive), len(lost), sum(r[0][name] for r in rows) - len(lost),
                    sum(r[0][name] and sum(r[0].values()) == 1 for r in rows),
                    sum(r[1] for r in lost), sum(r[2] for r in lost),
                )
        total = Counter()
        for (order, step), row in gone.items():
            total[order[step - 1]] += row[4]
        out += [(*row, total[order[step - 1]]) for (order, step), row in gone.items()]
    return sorted(out)


def got_audit(df):
    return sorted(tuple(r) for r in df.collect())


LABELS = "doc_id long, quality int, toxic int"


def test_op13_against_sql(spark):
    got = QUERIES["op13_filter_audit"](spark, SF)
    with duckdb.connect() as con:
        for name in ("documents", "labels"):
            con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
        found = con.execute(ORACLE["op13_filter_audit"])
        names = [d[0] for d in found.description]
        want = sorted(tuple(r[names.index(c)] for c in got.columns) for r in found.fetchall())
    assert got_audit(got) == want and len(want) % 600 == 0


@pytest.mark.parametrize("size", [1 << 16, 3])
def test_op13_odd_rows(spark, odd, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "RANGE", size)
    labels = [(1, 1, 0), (1, 0, 1), (6, 1, 1), (10, 0, 1), (None, 1, 1), (99, 1, 1), (7, None, None)]
    got = filter_audit.audit(odd, spark.createDataFrame(labels, LABELS))
    kept = [(i, q, t) for i, q, t in labels if i is not None]
    assert got_audit(got) == plain_audit(ODD, kept)


def test_op13_hot_part_and_copies(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE", 50)
    rng = random.Random(9)
    rows = []
    for i in range(700):
        text = rng.choice(["the very same text", "Some CAPITALS & signs", " ".join(rng.choices("ab", k=210)), f"own {i}"])
        rows.append((i, text, "en", None if i % 50 == 0 else "hot" if i % 3 else f"s{i % 5}"))
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 700, 3)]
    got = filter_audit.audit(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert got_audit(got) == plain_audit(rows, labels)


def test_op13_empty(spark, none):
    nothing = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, nothing).count() == 0
    clean = documents(spark, [(1, " ".join(f"w{i}" for i in range(300)), "en", "a")])
    rows = filter_audit.audit(clean, nothing).collect()
    assert len(rows) == 600 and {(r["kept"], r["removed"], r["shapley"]) for r in rows} == {(1, 0, 0)}


def test_merges():
    rng = random.Random(10)
    for _ in range(300):
        lists = [
            np.array(sorted(rng.sample(range(60), rng.randint(0, 50))), dtype=np.int32) for _ in range(rng.randint(1, 5))
        ]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*map(set, (x.tolist() for x in lists))))
        a, b = lists[0], lists[-1]
        assert filter_audit.difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
        at = rng.randint(0, len(a))
        target = rng.randint(0, 60)
        want = next((k for k in range(at, len(a)) if a[k] >= target), len(a))
        assert filter_audit.gallop(a, at, target) == want


# --- mended: two slices without any link -------------------------------------------------

def test_two_unrelated_slices_give_no_pair():
    from lotledger.llm import jaccard_join

    def tree(sizes, seed):
        rng = np.random.default_rng(seed)
        sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64)) for n in sizes]
        bits = jaccard_join.folded([jaccard_join.signature(s).tobytes() for s in sets], jaccard_join.SIGNATURE)
        return jaccard_join.Tree(np.array([len(s) for s in sets]), bits, np.arange(len(sets)) + 1000 * seed)

    for a, b in (([30] * 20, [300] * 20), ([300] * 20, [30] * 3), ([30], [300])):
        i, j = jaccard_join.traverse(tree(a, 1), tree(b, 2), False)
        assert len(i) == len(j) == 0


def test_wide_bitmaps_lose_no_link_and_fold():
    from lotledger.llm import jaccard_join

    rng = np.random.default_rng(3)
    sets = []
    for n in (5, 200, 300, 600, 1100, 3000, 9000, 20_000):
        base = rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64)
        for keep in (1.0, 0.97, 0.95, 0.9, 0.5, 0.1):
            more = rng.integers(0, 1 << 63, n - int(keep * n), dtype=np.int64).astype(np.uint64)
            sets.append(np.unique(np.concatenate([base[: int(keep * n)], more])))
    n, bitmaps = np.array([len(s) for s in sets]), [jaccard_join.signature(s, jaccard_join.WIDEST).tobytes() for s in sets]
    for size in (1024, 2048):
        for s, raw in zip(sets, bitmaps):
            if 8 * len(raw) >= size:
                want = np.zeros(size, dtype=bool)
                want[(s >> np.uint64(40)) % np.uint64(size)] = True
                assert jaccard_join.folded([raw], size).tobytes() == np.packbits(want).tobytes()
    x, y = np.triu_indices(len(sets), 1)
    ok = jaccard_join.wide_enough(n, bitmaps, x, y)
    both = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y)])
    links = 5 * both >= 4 * (n[x] + n[y] - both)
    assert ok[links].all() and links.sum() > 20
    unlike = (10 * both < 6 * np.minimum(n[x], n[y])) & (np.minimum(n[x], n[y]) > 500)
    assert not ok[unlike].any() and unlike.sum() > 50


# --- mended: vectors of several lengths, and components whose squares overflow --------------

VECTORS = "vec_id long, embedding array<double>"


def test_nearest_keeps_lengths_apart(spark):
    from lotledger.llm import permutation_index

    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.9, 0.1, 0.0]), (3, [0.0, 0.0, 1.0]), (50, [1.0, 1.0]), (7, [1.0, 0.9]), (8, [-1.0, 0.0]),
            (100, [1e200, 1e200, 0.0]), (9, [1.0, 1e-3, 1e-3, 0.0])]
    got = permutation_index.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0).collect()
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got}
    assert [found[50, k][0] for k in (1, 2)] == [7, 8] and (50, 3) not in found
    assert found[100, 1][0] == 2 and abs(found[100, 2][1] - 2 ** -0.5) < 1e-12 and found[100, 2][0] == 1
    assert found[100, 3] == (3, 0.0) and (100, 4) not in found


def test_near_vectors_of_any_size(spark):
    from lotledger.llm import sorted_projection

    rows = [(1, [1e200, 1e200, 0.0]), (2, [1.0, 1.0, 0.01]), (3, [1e-310, 1e-310, 0.0]), (4, [1.0, 1.0]), (5, [1e300, 1e300]), (6, [0.0, 0.0, 1.0])]
    got = sorted_projection.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {
        1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


# --- lines: buckets against all pairs ------------------------------------------------------

def line_sets(lines):
    return [{x[i: i + 8] for i in range(len(x) - 7)} for x in lines]


def joined(pairs, n):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_bucket_links_join_what_all_pairs_join():
    import pyarrow as pa

    from lotledger.llm import fuzzy_lines

    rng = random.Random(11)
    words = [b"alpha", b"beta", b"gamma", b"delta", b"eps", b"zeta ", b"x"]
    for size in (2, 3, 60):
        base = [b" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(size)]
        lines = base + [x[:-3] + b"yyy" for x in base if len(x) > 40] + [b"abc", b"abcdefgh", b"aaaaaaaa", b"aaaaaaaaaaaa", b""]
        sets = line_sets(lines)
        true = [
            (i, j) for i, j in itertools.combinations(range(len(lines)), 2)
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
        ]
        links = fuzzy_lines.Bucket(pa.array(lines, pa.binary()), np.arange(len(lines))).find(4, 5)
        assert joined(links, len(lines)) == joined(true, len(lines))
        assert all((min(x), max(x)) in set(true) for x in links) and len(links) <= len(lines)


def test_line_windows_do_not_cross_lines():
    import pyarrow as pa

    from lotledger.llm import fuzzy_lines

    lines = [b"0123456789", b"", b"short", b"\xc3\xa9\xc3\xa9\xc3\xa9\xc3\xa9z", b"12345678"]
    raw = pa.array([b"before", *lines], pa.binary()).slice(1)
    words, of = fuzzy_lines.window_words(raw)
    want = [(int.from_bytes(x[i: i + 8], "little"), k) for k, x in enumerate(lines) for i in range(len(x) - 7)]
    assert list(zip(words.tolist(), of.tolist())) == want
    assert [s for s in fuzzy_lines.slices(raw)] == [(0, 5)]


@pytest.mark.parametrize("size", [2048, 40])
def test_a_crowded_template(spark, monkeypatch, size):
    """Hundreds of lines of one template: near copies of a few, and lines that only share a beginning."""
    from lotledger.llm import fuzzy_lines

    monkeypatch.setattr(fuzzy_lines, "SLICE", size)
    rng = random.Random(12)
    head = "this notice stands in front of every single line of the table and says nothing at all: "
    tails = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=120)) for _ in range(300)]
    lines = [head + t for t in tails] + [head + t[:-4] + "wxyz" for t in tails[:150]]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[3 * i: 3 * i + 3])) for i in range(len(lines) // 3)]
    out = {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = [x for i in range(len(rows)) for x in out[i].split("\n") if x]
    raw = [x.encode() for x in lines]
    sets = line_sets(raw)
    true = [(i, j) for i, j in itertools.combinations(range(len(raw)), 2) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    root = joined(true, len(raw))
    assert kept == [x for i, x in enumerate(lines) if root[i] == i]


# --- pieces: units by number -----------------------------------------------------------

def test_units_are_numbered_as_they_are_cut(vocabulary):
    from lotledger.llm import nbest_pieces as NP

    rng = random.Random(13)
    texts = ["a", " a", "  a b  ", " ", "   ", "x\ny  z", "the the The", "\U0001f600 é ▁", "tail ", "a" * 300]
    texts += ["".join(rng.choices(" ab", k=rng.randint(1, 40))) for _ in range(200)]
    units = NP.Units(texts)
    cut = [NP.UNITS.findall(" " + t) for t in texts]
    for k, want in enumerate(cut):
        places = range(units.bounds[k], units.bounds[k + 1])
        assert [units.text(p) for p in places] == want
        assert [units.text(units.shown[units.number[p]]) for p in places] == want
    assert len(units.key) == len({u for c in cut for u in c})


def test_changes_give_the_segmentations(spark, vocabulary, monkeypatch):
    from lotledger.llm import nbest_pieces as NP

    monkeypatch.setattr(NP, "CACHE", 50)  # known units are forgotten on the way
    texts = ["the inning of the thing", "üben wir es", "", "a  b", "the inning of the thing", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = NP.encode(df, vocabulary, n=4).orderBy("doc_id").collect()
    assert rows[0][1:] == rows[4][1:] and rows[5]["nbest_changes"] is None
    encoder = NP.Encoder(vocabulary, 4)
    for r, text in zip(rows, texts):
        if not text:
            continue
        found = NP.nbest_ids(r["ids"], [[c.asDict() for c in change] for change in r["nbest_changes"]])
        assert found[0] == r["ids"] and len({tuple(x) for x in found}) == len(found)
        assert all(NP.decode_ids(x, vocabulary) == text for x in found)
        assert [len(x) for x in found] == r["nbest_pieces"]
        cut = NP.UNITS.findall(" " + text)
        encoder.prepare(set(cut))
        assert [round(s, 9) for s, _ in encoder.nbest(cut)[1]] == [round(s, 9) for s in r["nbest_scores"]]


# --- links of the n-gram join ---------------------------------------------------------------

def plain_links(rows):
    """(doc_id, text) to the number of other rows that link directly."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i: i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    out = []
    for k, (i, _) in enumerate(rows):
        n = sum(
            1 for j, s in enumerate(sets) if j != k and s and sets[k]
            and 5 * len(s & sets[k]) >= 4 * len(s | sets[k])
        )
        out.append((i, len(sets[k]), n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [512, 7])
def test_links_are_counted_with_copies(spark, monkeypatch, size):
    from lotledger.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "LINKED", size)
    monkeypatch.setattr(jaccard_join, "WIDE", 50)
    rng = random.Random(21)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choices(words, k=60) for _ in range(4)]
    rows = []
    for i in range(120):
        text = list(base[0 if i % 3 == 0 else rng.randint(1, 3)])
        for _ in range(rng.randint(0, 2)):
            text[rng.randint(0, 59)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(200 + i, rows[3 * i][1]) for i in range(20)] + [(300, None), (301, ""), (302, "two words"), (303, "Two words"), (None, rows[0][1])]
    got = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got.collect()), key=repr) == plain_links(rows)


def test_op2_links_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op2_jaccard_join"](spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got), key=repr) == plain_links(rows)
