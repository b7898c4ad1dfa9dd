import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from incident_engine.llm import near_dups, suffixes, toxicity


def brute_repeats(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = defaultdict(int)
    for data in texts:
        for i in range(len(data) - 399):
            seen[data[i:i + 400]] += 1
    out = []
    for (doc_id, _), data in zip(rows, texts, strict=True):
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 399):
            if seen[data[i:i + 400]] > 1:
                gone[i:i + 400] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeats(docs):
    return sorted((tuple(r) for r in suffixes.remove_repeats(docs).collect()), key=str)


def test_repeats_match_brute_force_on_documents(documents):
    rows = [tuple(r) for r in documents.filter("n_chars < 9000").select("doc_id", "text").collect()]
    assert repeats(documents.filter("n_chars < 9000")) == brute_repeats(rows)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_match_brute_force_on_overlaps(spark, seed):
    """Passages cut at all places, so that one text's strings are shared left with one text and
    right with another, within and across texts."""
    rng = random.Random(seed)
    letters = "ab" if seed == 3 else "abcdefgh é"
    pool = ["".join(rng.choices(letters, k=rng.randint(100, 900))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a:a + rng.randint(50, 900)], "".join(rng.choices(letters, k=rng.randint(0, 40)))]
        rows.append((i, "".join(parts)))
    rows.append((99, "a" * 1500))
    rows.append((98, "ab" * 450))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert repeats(docs) == brute_repeats(rows)


def test_repeats_of_odd_rows(odd, empty):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert repeats(odd) == brute_repeats(rows)
    assert repeats(empty) == []
    stripped = suffixes.strip_repeats(odd)
    assert stripped.columns == odd.columns and stripped.count() == odd.count()


def test_long_texts_are_read_in_chunks(monkeypatch):
    data = random.Random(5).randbytes(5000)
    want = [x.tolist() for x in suffixes.anchors(data)]
    monkeypatch.setattr(suffixes, "_CHUNK", 700)
    assert [x.tolist() for x in suffixes.anchors(data)] == want


def test_family_levels_grow_geometrically(spark):
    family = suffixes.SuffixFamily()
    found = []
    for i in range(7):
        batch = spark.createDataFrame([(i * 10 + j,) for j in range(5)] + [(7,), (i * 10,)], "fp long")
        found.append(sorted(r[0] for r in family.add(batch).collect()))
        assert sum(n for n, _ in family.levels) == i + 1
    assert [n for n, _ in family.levels] == [4, 2, 1]
    assert found[0] == [0] and found[1] == [7, 10] and found[6] == [7, 60]


def jaccard(a, b):
    one, two = (set(near_dups.shingles(near_dups.word_ids(t)).tolist()) for t in (a, b))
    return len(one & two) / max(len(one | two), 1)


def test_edit_distance_matches_a_plain_table():
    rng = random.Random(3)
    for _ in range(200):
        a, b = (np.array(rng.choices(range(4), k=rng.randint(0, 14)), np.uint64) for _ in "ab")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        table[:, 0], table[0] = range(len(a) + 1), range(len(b) + 1)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i, j] = min(table[i - 1, j - 1] + (a[i - 1] != b[j - 1]),
                                  table[i - 1, j] + 1, table[i, j - 1] + 1)
        for most in (0, 2, 20):
            assert near_dups.edit_distance(a, b, most) == min(table[-1, -1], most + 1)


def test_near_classes_match_brute_force(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    grams = {d: np.unique(near_dups.shingles(near_dups.word_ids(t))) for d, t in rows}
    meet = defaultdict(set)
    for d, g in grams.items():
        for x in g.tolist():
            meet[x].add(d)
    words, texts = {d: near_dups.word_ids(t) for d, t in rows}, dict(rows)
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = {(a, b) for ids in meet.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        if texts[a] == texts[b] or near_dups.near(words[a], words[b]):
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.doc_id: r.class_id for r in near_dups.near_classes(documents).collect()}
    assert got == {d: find(d) for d in root}


def test_large_groups_are_linked_through_their_centre(spark):
    """Hundreds of near copies of one text, each with edits of its own, and clean texts."""
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(220)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        words = base[:]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(220)] = f"v{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(words)))
    clean = [(1000 + i, " ".join(f"c{rng.randint(0, 10**9)}" for _ in range(200))) for i in range(50)]
    docs = spark.createDataFrame(rows + clean, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dups.near_classes(docs).collect()}
    assert all(got[d] == 0 for d, t in rows if jaccard(t, rows[0][1]) >= 0.82)
    assert all(got[d] == d for d, _ in clean)
    kept = [r.doc_id for r in near_dups.keep_first(docs).collect()]
    assert len(kept) == len(set(kept)) == len(set(got.values()))


def test_rounds_compare_all_texts_of_different_classes(spark):
    """A bucket with one large class, a class of two and texts of their own, next to a bucket of
    one class: the rounds give exactly the pairs between classes, each text leading at most once."""
    root = {i: 0 if i < 30 else 40 if i in (40, 41) else i for i in range(60)}
    rest = spark.createDataFrame([(1, i) for i in root] + [(2, i) for i in range(20)],
                                 "bucket long, id long")
    roots = spark.createDataFrame(
        [(i, r) for i, r in root.items() if r in (0, 40)], "id long, root long")
    found, met, step = set(), None, 0
    while more := near_dups._bridges(rest, roots, met, step):
        (pairs, met), step = more, step + 1
        found |= {tuple(r) for r in pairs.collect()}
    assert found == {(a, b) for a in root for b in root if a < b and root[a] != root[b]}
    assert step <= 7
    led = [tuple(r) for r in met.collect()]
    assert len(led) == len(set(led)) == 30


def test_chains_in_large_buckets_stay_whole(spark, monkeypatch):
    """Each text is near only to the one before and after it, and every bucket counts as large."""
    monkeypatch.setattr(near_dups, "SMALL", 2)
    monkeypatch.setattr(near_dups, "LEADERS", 1)
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 10**9)}" for _ in range(300)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join(words)))
        for _ in range(4):
            words[rng.randrange(300)] = f"v{rng.randint(0, 10**9)}"
    got = near_dups.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_near_pairs_of_a_hot_template_match_brute_force(spark):
    """Texts from one template that resemble each other at less than 0.8, each with a partner at
    0.80 to 0.85: buckets of one and of two sketches are large, and some partners share no third."""
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(220)]

    def edited(words, places):
        out = words[:]
        for i in places:
            out[i] = f"v{rng.randint(0, 10**9)}"
        return out

    texts = []
    for _ in range(200):
        places = rng.sample(range(3, 217, 6), 8)
        one = edited(base, places[:4])
        texts += [one, edited(one, places[4:])]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    words = [near_dups.word_ids(t) for _, t in rows]
    sets = [set(near_dups.shingles(w).tolist()) for w in words]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.79 * (len(sets[a]) + len(sets[b]) - both) and near_dups.near(words[a], words[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert sum(find(i) == i for i in root) > 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dups.near_classes(docs).collect()}
    assert got == {i: find(i) for i in range(len(rows))}


def test_near_classes_of_odd_rows(odd, empty):
    got = near_dups.near_classes(odd).collect()
    assert len(got) == odd.count()
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.class_id)
    assert by[9] == by[10] == {9} and by[0] == {0} and by[1] == {0} and by[8] == {8}
    kept = near_dups.keep_first(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({(r.class_id) for r in got})
    assert near_dups.near_classes(empty).count() == near_dups.keep_first(empty).count() == 0


def test_rows_are_told_apart_by_id_and_text(spark, tmp_path):
    """Several null ids, and ids on different texts: a near copy goes, no other text does."""
    rng = random.Random(2)
    text = [" ".join(f"w{rng.randint(0, 10**9)}" for _ in range(120)) for _ in range(6)]
    rows = [(None, text[0]), (None, text[1]), (None, text[1]), (1, text[2]), (2, text[2] + " end"),
            (2, text[3]), (3, text[4]), (3, text[5]), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in near_dups.keep_first(docs).collect()), key=str)
    assert kept == sorted({r for r in rows if r != rows[4]}, key=str)

    spark.createDataFrame([(1, text[1]), (2, text[4])], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.benchmarks_out(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted((tuple(r) for r in left.collect()), key=str) == sorted(
        (r for r in rows if r[1] not in (text[1], text[4])), key=str)


def test_toxic_rows_go_by_id_and_text(spark, monkeypatch):
    lexicon = {"bad": 3.0}
    rows = [(y, toxicity.features(t, lexicon)) for t, y in (("bad", 1), ("fine", 0))] * 50
    model = toxicity.Model(lexicon, rows, list(range(100)))
    monkeypatch.setattr(toxicity, "train", lambda *a: model)
    monkeypatch.setattr(corpus_pipeline, "read", lambda *a: None)
    docs = spark.createDataFrame([(None, "bad"), (None, "fine"), (1, "bad"), (1, "good")],
                                 "doc_id long, text string")
    left = corpus_pipeline.toxic_out(spark, docs, "")
    assert sorted(r.text for r in left.collect()) == ["fine", "good"]


def test_signatures_rule_out_no_near_pair():
    """The bound on shared shingles by signatures is never below what two texts share."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 900))
        one = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        two = np.unique(np.concatenate((one[rng.random(len(one)) < rng.random()],
                                        rng.integers(0, 1 << 60, int(rng.integers(1, 400))).astype(np.uint64))))
        a, b = (near_dups.signature(x).view(np.uint64) for x in (one, two))
        lack = [sum(int(x).bit_count() for x in p & ~q) for p, q in ((a, b), (b, a))]
        both = len(np.intersect1d(one, two))
        assert both <= min(len(one) - lack[0], len(two) - lack[1])


def brute_strip(texts, length):
    """Bytes of strings that start at two places or more, taken out of every text."""
    seen = {}
    datas = [(t or "").encode() for t in texts]
    for d in datas:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in datas:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(d, gone) if not g).decode(errors="ignore"))
    return out


@pytest.mark.parametrize("length", [128, 240, 400])
def test_shorter_passages_equal_brute_force(spark, length):
    """Passages of 51 to 70 words stand in several texts, whole or in part."""
    pick = random.Random(length)
    word = lambda: "".join(pick.choices("abcdefghijé", k=pick.randint(2, 8)))
    planted = [" ".join(word() for _ in range(pick.randint(51, 70))) for _ in range(6)]
    texts = [None, "", planted[0], planted[0] * 2]
    for i in range(40):
        parts = [" ".join(word() for _ in range(pick.randint(5, 60))) for _ in range(3)]
        if i % 2:
            cut = pick.choice(planted)
            parts.insert(1, cut[pick.choice([0, 0, 40]):])
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in suffixes.strip_repeats(docs, length=length).collect()}
    assert [got[i] or "" for i in range(len(texts))] == brute_strip(texts, length)
    with pytest.raises(ValueError, match="length must be"):
        suffixes.strip_repeats(docs, length=100)


def test_rounds_merge_classes_without_going_through_old_links(spark, monkeypatch):
    """Links found in the rounds are joined in through the roots of their ends: after the first
    call, components never gets the links found before again, and classes still form."""
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(220)]

    def edited(words, places):
        out = words[:]
        for i in places:
            out[i] = f"v{rng.randint(0, 10**9)}"
        return out

    texts = []
    for _ in range(200):
        places = rng.sample(range(3, 217, 6), 8)
        one = edited(base, places[:4])
        texts += [one, edited(one, places[4:])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string")
    given, plain = [], near_dups.components

    def counted(edges, name, *more):
        given.append(edges.count())
        return plain(edges, name, *more)

    monkeypatch.setattr(near_dups, "components", counted)
    got = {r.doc_id: r.class_id for r in near_dups.near_classes(docs).collect()}
    assert len(given) >= 2
    assert all(n < given[0] for n in given[1:])
    assert len(set(got.values())) < len(texts)
