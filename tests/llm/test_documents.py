"""Sharding, near-duplicates, fingerprints, passages, toxicity, search and the pipeline against brute force."""

import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.conftest import WORDS, words
from tickloom.llm import components, fingerprints, minhash, passages, sharding, topk, toxicity
from tickloom.llm.common import global_index, read_table
from tickloom.llm.queries import registry


# ---- sharding ---------------------------------------------------------------------------------------------------
def law_holds(rows, n):
    counts = Counter(row.shard for row in rows)
    sizes = [counts[s] for s in range(sharding.SHARDS)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for shard in counts:
        assert sorted(row.slot for row in rows if row.shard == shard) == list(range(counts[shard]))


def test_op2_shards(spark, sf_dir, given):
    rows = registry()["op2_sharding"](spark, sf_dir).collect()
    law_holds(rows, len(given))
    texts = dict(given)
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 1, zlib.crc32(data), "rows")


def test_only_the_overflow_leaves_home(spark, docs_of):
    docs = docs_of([(i, "x") for i in range(999)])
    rows = {row.doc_id: row.shard for row in sharding.shard(docs).collect()}
    ring = {row.cell: row.prefs for row in sharding.ring(spark, 8).collect()}
    cells = {r.doc_id: r.cell for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 4096) AS cell").collect()}
    homes = Counter(ring[cells[i]][0] for i in rows)
    room = {s: 999 // 8 + (s < 999 % 8) for s in range(8)}
    over = sum(max(0, homes[s] - room[s]) for s in room)
    assert sum(rows[i] != ring[cells[i]][0] for i in rows) == over
    for i, shard in rows.items():  # a row that left passed only shards that are full
        passed = ring[cells[i]][: ring[cells[i]].index(shard)]
        assert all(Counter(rows.values())[s] == room[s] for s in passed)
    assert all(sorted(p) == list(range(8)) for p in ring.values())


def test_one_id_for_a_third_of_the_rows(docs_of):
    rows = sharding.shard(docs_of([(7, f"t{i % 3}") for i in range(200)] + [(i, "y") for i in range(400)])).collect()
    law_holds(rows, 600)


def test_shards_of_odd_rows(odd, odd_rows, no_rows):
    law_holds(sharding.shard(odd).collect(), len(odd_rows))
    assert sharding.shard(no_rows).count() == 0


def test_global_index(spark):
    frame = spark.range(1000).selectExpr("(id * 37) % 101 AS k", "id")
    rows = global_index(frame, ["k", "id"], "i").orderBy("i").collect()
    assert [row.i for row in rows] == list(range(1000))
    assert [(row.k, row.id) for row in rows] == sorted((row.k, row.id) for row in rows)


# ---- near-duplicates --------------------------------------------------------------------------------------------
def shingles(text):
    found = (text or "").encode().lower().split()
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def groups(docs):
    sets = defaultdict(list)
    for i, text in docs:
        if i is not None:
            sets[i].append(shingles(text))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            for x in sets[a]:
                for y in sets[b]:
                    common = len(x & y)
                    if common and 100 * common >= 75 * (len(x) + len(y) - common):
                        low, high = sorted((root(a), root(b)))
                        parent[high] = low
    return {i: root(i) for i in ids}


def near_copies(count, base, edits, seed):
    generator = random.Random(seed)
    out = []
    for _ in range(count):
        text = WORDS[base : base + 200]
        for _ in range(edits):
            text[generator.randrange(200)] = generator.choice(WORDS)
        out.append(" ".join(text))
    return out


def test_op3_equals_brute_force(spark, sf_dir, given):
    rows = registry()["op3_minhash"](spark, sf_dir).collect()
    expected = groups(given)
    assert len(rows) == len(given)
    for row in rows:
        assert row.component_id == expected[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)
    assert {row.doc_id: row.n_shingles for row in rows} == {i: len(shingles(t)) for i, t in given}


def test_large_groups_and_a_common_passage(docs_of):
    """Near copies around the threshold, chains of them, exact copies, and short texts with half of them in common."""
    texts = near_copies(60, 0, 4, 1) + near_copies(40, 300, 7, 2) + [words(600, 90)] * 30
    texts += [words(1000, 40) + " " + words(1100 + 30 * i, 30) for i in range(60)]
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    found = minhash.near_duplicates(docs_of(rows)).collect()
    assert {row.doc_id: row.component_id for row in found} == groups(rows)


def test_near_duplicates_of_odd_rows(odd, odd_rows, no_rows):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    expected = groups(odd_rows)
    for row in rows:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert row.component_id == expected[row.doc_id]
    assert minhash.near_duplicates(no_rows).count() == 0


def test_a_repeated_id_whose_second_text_has_a_near_copy(docs_of):
    """One text of document 5 is folded into document 3; the other one keeps its links, also if texts differ in size."""
    other = WORDS[500:600]
    rows = [(5, words(0, 400)), (5, " ".join(other)), (3, words(0, 400)), (2, " ".join(other[:90] + ["changed"] + other[91:]))]
    found = minhash.near_duplicates(docs_of(rows)).collect()
    assert len(found) == 4 and {row.doc_id: row.component_id for row in found} == groups(rows) == {5: 2, 3: 2, 2: 2}


def test_texts_edited_too_much_meet_by_what_they_can_share(docs_of):
    random = np.random.default_rng(3)
    texts = []
    for i in range(120):
        kept = np.sort(random.permutation(140)[10:])
        texts.append([WORDS[j] for j in kept])
        if i % 10 == 0:
            texts.append(texts[-1][:-2])
    texts.append(texts[5][:100])  # a short one lets all others meet by more of their shingles
    docs = docs_of([(i, " ".join(text)) for i, text in enumerate(texts)])
    sets = [frozenset(minhash.shingle_set(" ".join(text)).tolist()) for text in texts]
    rows = [(i, 1, len(s), len(s), min(map(len, sets)), 1) for i, s in enumerate(sets)]
    members = docs.sparkSession.createDataFrame(rows, "node long, weight long, n long, common long, least long, texts long")
    by_bucket = {}
    for row in minhash._by_rare_shingles(members, docs, minhash.PERCENT).collect():
        by_bucket.setdefault(row["bucket"], []).append(row)
    met = [
        (a["node"], b["node"]) for rows in by_bucket.values() for a, b in combinations(sorted(rows, key=lambda r: r["node"]), 2)
        if 175 * min(a["common"], b["common"]) >= 75 * (a["n"] + b["n"])
    ]
    linked = {(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(linked) >= 12 and linked <= set(met)
    assert len(met) < 5000  # 10,353 where only the shortest text of a bucket bounds them


def test_bounds_keep_pairs_at_the_threshold():
    bounds = minhash.least_matches(200)
    assert list(bounds) == sorted(bounds) and bounds[-1] < 150
    generator = np.random.default_rng(1)
    a = generator.integers(0, 256, 200, dtype=np.uint8)
    alike = np.where(generator.random(200) < 0.75, a, a + 1).astype(np.uint8)
    assert minhash.survives(a.tobytes(), alike.tobytes(), bounds)
    assert not minhash.survives(a.tobytes(), (a + 1).astype(np.uint8).tobytes(), bounds)


def test_components(spark):
    generator = random.Random(9)
    edges = [(generator.randrange(300), generator.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(100)] + [(7, 7)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {row.node: row.component for row in components.components(frame).collect()}
    assert all(found.get(i, i) == root(i) for i in parent)
    assert components.components(frame.limit(0)).count() == 0


# ---- fingerprints -----------------------------------------------------------------------------------------------
def test_op4_texts_and_likeness(spark, sf_dir, given):
    rows = {row.doc_id: row for row in registry()["op4_fingerprints"](spark, sf_dir).collect()}
    ordered = sorted(given, reverse=True)
    marks = defaultdict(set)
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert fingerprints.spelt(fingerprints.sketch(text)) == row.fingerprint
        assert fingerprints.spelt(fingerprints.sketch(edited)) == row.edited_fingerprint
        assert row.near_edited == fingerprints.resemblance(fingerprints.sketch(text), fingerprints.sketch(edited))
        assert 0 <= row.near_next <= 1
        marks[text].add(row.fingerprint)
    assert len(rows) == len(given) and all(len(m) == 1 for m in marks.values())
    assert np.mean([row.near_edited > row.near_next for row in rows.values()]) > 0.95


def test_sketches_merge_and_contain():
    whole, part = words(0, 2000), words(500, 400)
    a, b = fingerprints.sketch(whole), fingerprints.sketch(part)
    assert fingerprints.containment(a, b) > 0.9 and fingerprints.resemblance(a, b) < 0.4
    other = fingerprints.sketch(words(2500, 300))
    assert fingerprints.merge(a, other).tolist() == sorted({*a.tolist(), *other.tolist()})
    assert fingerprints.read(fingerprints.spelt(a)).tolist() == a.tolist()
    assert len(fingerprints.sketch("")) == 0 and len(fingerprints.sketch("a")) == 1


def test_fingerprints_of_odd_rows(odd, odd_rows, no_rows, docs_of):
    rows = fingerprints.compare_with_next(odd).collect()
    assert sorted(str(row.doc_id) for row in rows) == sorted(str(i) for i, _ in odd_rows)
    assert fingerprints.compare_with_next(no_rows).count() == 0
    (alone,) = fingerprints.compare_with_next(docs_of([(3, "abcd")])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1.0
    assert fingerprints.fingerprints(odd).count() == len(odd_rows)


# ---- passages ---------------------------------------------------------------------------------------------------
def test_windows_cover_every_run_once():
    hashes = np.random.default_rng(2).integers(0, 50, 240)
    windows = list(zip(*passages.compact_windows(hashes, np.array([0, 120]), np.array([120, 240]), 20)))
    for low in (0, 120):
        for a in range(low, low + 120):
            for b in range(a + 20, low + 121):
                inside = [c for f, c, e in windows if f <= a <= c < b <= e]
                assert inside[0] == a + int(hashes[a:b].argmin()) and len({hashes[c] for c in inside}) == 1


def test_words_are_hashed_as_they_are_cut(monkeypatch):
    """Equal hashes for equal words and for them alone, whatever the blocks; texts that touch, and empty ones."""
    texts = ["", "Ab ab\tAB  x", "x", " ", "é É ab", "", "a" * 300 + " b", "long " * 50, "İx ſ\x00 \x1c y\x0b\x0cz\r\n"]
    monkeypatch.setattr(passages, "_BLOCK", 16)
    array = pa.array(["skipped", *texts]).slice(1)
    hashes, offsets = passages.hashed_words(array)
    found = [word for text in texts for word in text.encode().lower().split()]
    assert np.diff(offsets).tolist() == [len(text.encode().split()) for text in texts]
    assert len(set(zip(found, hashes.tolist()))) == len(set(found)) == len(set(hashes.tolist()))


def test_cells_hold_the_least_shingles_of_their_runs():
    """Each run of the least length lies in one cell a pair of functions, and equal runs have equal cells."""
    generator = random.Random(5)
    texts = [" ".join(f"w{generator.randrange(40)}" for _ in range(n)) for n in (49, 50, 200, 0, 131)]
    texts += ["same line again " * 60, texts[2]]
    hashes, offsets = passages.hashed_words(pa.array(texts))
    bucket, text, first, end = passages.cells(hashes, offsets)
    by_text = [{(b, f, e) for b, t, f, e in zip(bucket, text, first, end) if t == i} for i in range(len(texts))]
    assert not by_text[0] and not by_text[3] and by_text[2] == by_text[6] and len(by_text[1]) == passages.PAIRS
    marked = sorted((f, e) for b, f, e in by_text[2] if b & np.uint64(1))
    assert [f for f, e in marked] == [0] + [e - 45 for f, e in marked[:-1]] and marked[-1][1] == 196
    assert all(e < 0 for b, f, e in by_text[5])


def exact_repeats(docs, size=50):
    first, covered = {}, {}
    for i, text in sorted(docs):
        found = (text or "").encode().lower().split()
        mark = bytearray(len(found))
        for k in range(len(found) - size + 1):
            run = tuple(found[k : k + size])
            where = first.setdefault(run, (i, k))
            if where[0] != i or where[1] + size <= k:
                mark[k : k + size] = b"\1" * size
        covered[i] = mark
    return covered


def marked(rows, docs):
    found = {i: bytearray(len((t or "").encode().lower().split())) for i, t in docs}
    for row in rows:
        found[row.doc_id][row.start : row.end] = b"\1" * (row.end - row.start)
    return found


def test_op6_finds_all_exact_repeats(spark, sf_dir, given):
    rows = registry()["op6_passages"](spark, sf_dir).collect()
    found, texts = marked(rows, given), dict(given)
    for i, mark in exact_repeats(given).items():
        assert all(f or not m for m, f in zip(mark, found[i])), i
    for row in rows:
        def part(doc, start, end):
            run = texts[doc].encode().lower().split()[start:end]
            return {tuple(run[k : k + 5]) for k in range(len(run) - 4)}

        a = part(row.doc_id, row.start, row.end)
        b = part(row.source_doc_id, row.source_start, row.source_end)
        assert row.end - row.start >= 50 and row.source_doc_id <= row.doc_id
        assert 100 * len(a & b) >= 75 * len(a | b)


def test_passages_planted_in_other_texts(docs_of):
    """One passage in many texts, with words changed in some, and others that only use a phrase of it."""
    passage = WORDS[0:60]
    near = passage[:30] + ["changed"] + passage[31:]
    rows = [(i, words(100 + 40 * i, 40) + " " + " ".join(near if i % 4 == 1 else passage)) for i in range(30)]
    rows += [(100 + i, words(2000 + 40 * i, 35) + " " + " ".join(passage[20:32])) for i in range(20)]
    found = marked(passages.repeated_passages(docs_of(rows)).collect(), rows)
    for i, text in rows:
        if 0 < i < 100:
            assert sum(found[i][40:]) >= 55 and not any(found[i][:40]), i
        else:
            assert not any(found[i])


def test_first_documents_that_hold_only_parts(docs_of):
    """Sixty words that two documents share, word for word or nearly, after ones that hold only parts of them."""
    rows = []
    for i in range(30):
        passage = WORDS[100 * i : 100 * i + 60]
        near = passage[:12] + ["changed"] + passage[13:]
        parts = [passage[:40], passage[20:], passage[:45], passage, passage if i % 2 else near]
        rows += [(1000 * k + i, f"a{k}x{i} " * 3 + " ".join(part) + f" b{k}x{i}" * 3) for k, part in enumerate(parts)]
    found = marked(passages.repeated_passages(docs_of(rows)).collect(), rows)
    assert all(not any(found[k * 1000 + i]) for k in range(3) for i in range(30))
    assert all(all(found[4000 + i][3:63]) for i in range(30))


@pytest.mark.parametrize("quoted", [6, 20, 40, 45])
@pytest.mark.parametrize("near", [False, True])
def test_a_source_that_quotes_the_opening_first(quoted, near):
    passage = WORDS[0:70]
    again = passage[:20] + ["changed"] + passage[21:] if near else passage
    source = passage[:quoted] + WORDS[100:200] + passage + WORDS[200:220]
    for text, base in ((WORDS[300:310] + again + WORDS[310:320], 10), (source + WORDS[300:310] + again, len(source) + 10)):
        hashes = minhash.word_hashes(" ".join(text))
        of = None if base > 10 else minhash.word_hashes(" ".join(source))
        covered = set()
        for start, end, *_ in passages.shared_passages(hashes, of):
            covered |= set(range(start, end))
        assert covered >= set(range(base, base + 70)) and min(covered) >= base


def test_near_passages_in_short_documents_are_candidates():
    """Similarity 0.75 to 0.85, without other words around or with few."""
    generator, missed = random.Random(8), 0
    for i in range(600):
        length, edits, around = ((55, 1, 0), (52, 1, 0), (60, 2, 0), (52, 1, 5), (55, 1, 20), (60, 1, 5))[i % 6]
        fresh = iter(f"v{i}y{generator.randrange(10**9)}" for _ in range(1000))
        passage = [next(fresh) for _ in range(length)]
        near = list(passage)
        for k in generator.sample(range(length), edits):
            near[k] = next(fresh)
        texts = pa.array([" ".join([next(fresh) for _ in range(around)] + t) for t in (passage, near)])
        bucket, text, *_ = passages.cells(*passages.hashed_words(texts))
        missed += not set(bucket[text == 0].tolist()) & set(bucket[text == 1].tolist())
    assert missed <= 18  # 3%


def test_texts_are_sent_once_to_a_square_of_pairs(docs_of):
    docs = docs_of([(i, words(i, 60)) for i in range(60)])
    all_pairs = {(a, b) for a in range(60) for b in range(a + 1, 60)}
    pairs = docs.sparkSession.createDataFrame([(a, b, [(0, 1, 0, 1)]) for a, b in all_pairs], (
        "lead long, doc_id long, cells array<struct<first: int, end: int, lead_first: int, lead_end: int>>"
    ))
    rows = passages.in_squares(docs, pairs, 4).collect()
    leads, others = [[r for r in rows if (r.leads is None) is lead] for lead in (True, False)]
    assert len(rows) <= 60 * 8 < len(all_pairs)
    assert sorted((p.lead, r.doc_id) for r in others for p in r.leads) == sorted(all_pairs)
    there = {(r.square, r.doc_id) for r in leads}
    assert len(there) == len(leads) and there == {(r.square, p.lead) for r in others for p in r.leads}


def test_documents_of_one_bucket_meet_in_few_squares(docs_of):
    docs = docs_of([(i, words(i, 60)) for i in range(200)])
    all_pairs = {(a, b) for a in range(200) for b in range(a + 1, 200) if a // 20 == b // 20}
    pairs = docs.sparkSession.createDataFrame([(a, b, [(0, 1, 0, 1)]) for a, b in all_pairs], (
        "lead long, doc_id long, cells array<struct<first: int, end: int, lead_first: int, lead_end: int>>"
    ))
    rows = passages.in_squares(docs, pairs, 16).collect()
    assert sorted((p.lead, r.doc_id) for r in rows if r.leads for p in r.leads) == sorted(all_pairs)
    assert len(rows) == 2 * (200 - 10)


def test_texts_that_go_to_many_squares_are_sent_in_turns(docs_of, monkeypatch):
    rows = [(i, words(i * 60, 60) + " " + words(3900, 60)) for i in range(40)]
    docs, sent, rows_by = docs_of(rows), [], passages.texts_in_squares
    met = docs.sparkSession.createDataFrame(
        [(a, b, 60, 116, 60, 116) for a in range(40) for b in range(a + 1, 40)],
        "lead long, doc_id long, first int, end int, lead_first int, lead_end int",
    )

    def counted(docs, placed):
        sent.append(sum(len(r.text) for r in rows_by(docs, placed).collect()))
        return rows_by(docs, placed)

    monkeypatch.setattr(passages, "texts_in_squares", counted)
    monkeypatch.setattr(passages, "GROUP", 4)
    room, found = sum(len(t) for _, t in rows), []
    for most in (room, 100 * room):
        sent.clear()
        turns = passages._compared(docs, met, most, 50, 75)
        found.append(sorted(tuple(r) for turn in turns for r in turn.collect()))
        assert len(turns) == len(sent) == -(-sum(sent) // most) and max(sent) < 2 * most and sum(sent) > 2 * room
    assert found[0] == found[1] and len(found[0]) == 40 * 39 // 2


def test_passages_found_in_turns(docs_of, monkeypatch):
    rows = [(i, words(i * 60, 30) + " " + words(3000 + i % 2 * 10, 70)) for i in range(8)]
    docs = docs_of(rows)
    whole = sorted(map(tuple, passages.repeated_passages(docs).collect()))
    names, store = [], passages.materialize
    monkeypatch.setattr(passages, "room_of", lambda docs: 3000)
    monkeypatch.setattr(passages, "materialize", lambda df, name: names.append(name) or store(df, name))
    assert sorted(map(tuple, passages.repeated_passages(docs).collect())) == whole and len(whole) >= 7
    assert names.count("passage-diagonals") > 1 and names.count("passage-pairs") > names.count("passage-rest")
    assert names.count("passages-across") > names.count("passage-pairs")


def test_a_word_that_goes_on_in_both_is_aligned_only_where_a_passage_can_be(monkeypatch):
    calls, aligned = [], passages._Alignment._passages
    monkeypatch.setattr(passages._Alignment, "_passages", lambda self, *of: calls.append(of) or aligned(self, *of))

    def shared(text, source):
        return passages.shared_passages(*(passages.hashed_words(pa.array([t]))[0] for t in (text, source)))

    short, long = "the " * 47, "the " * 300
    assert shared(long, f"{words(0, 80)} {short} {words(100, 80)}") == [] and not calls
    assert shared(f"{words(0, 80)} {short} {words(100, 80)}", long) == [] and not calls
    assert shared(f"{words(200, 20)} {long}", f"{long} {words(300, 20)}")[0][:2] == (20, 320)


def test_too_few_equal_shingles_for_any_passage():
    rng = np.random.default_rng(5)
    for _ in range(300):
        same = rng.random(rng.integers(1, 90)) < rng.uniform(0.4, 0.9)
        place = int(rng.integers(len(same)))
        spans = [(s, e) for s in range(len(same)) for e in range(s + 46, len(same) + 1) if 100 * same[s:e].sum() >= 75 * (e - s)]
        assert passages._dense(same, 46, 75) == bool(spans)
        assert passages._dense(same, 46, 75, place) == any(s <= place < e + 4 for s, e in spans)


def test_variants_of_variants_and_sources_full_of_fragments(docs_of):
    """C is like B, which is like A, but C is not like A; and a source that holds pieces of a passage many times."""
    rows, missed = [], 0
    for i in range(40):
        a = [f"p{i}w{k}" for k in range(55)]
        b = a[:18] + ["once"] + a[19:]
        c = b[:36] + ["twice"] + b[37:]
        rows += [(10 * i + k, f"q{i}k{k} " * 6 + " ".join(t) + f" r{i}k{k}" * 6) for k, t in enumerate((a, b, c))]
    passage = [f"z{k}" for k in range(60)]
    pieces = " ".join(" ".join([*passage[20:44], f"n{k}"]) for k in range(60))
    rows += [(1000, pieces + " " + " ".join(passage)), (1001, "own words " + " ".join([*passage[:9], "x", *passage[10:]]))]
    found = marked(passages.repeated_passages(docs_of(rows)).collect(), rows)
    for i in range(40):
        missed += sum(found[10 * i + 2][6:61]) < 50
    assert missed <= 4 and sum(found[1001]) >= 55


def test_texts_of_one_id_that_share_a_passage(docs_of):
    passage = words(0, 70)
    rows = [(5, f"one {passage} two"), (5, f"three {passage} four"), (6, "clean")]
    kept = [row.text for row in passages.remove_repeats(docs_of(rows)).collect()]
    assert sorted(text.count(passage) for text in kept) == [0, 0, 1] and len(kept) == 3


def test_repeats_are_cut_out(docs_of):
    passage = words(0, 70)
    rows = [(1, f"one {passage} two"), (2, f"Three {passage.upper()}\nfour five"), (3, passage), (4, None), (5, "clean")]
    kept = {row.doc_id: row for row in passages.remove_repeats(docs_of(rows)).collect()}
    assert kept[1].text == rows[0][1] and kept[2].text == "Three four five" and kept[3].text == ""
    assert kept[4].text is None and kept[5].text == "clean" and kept[2].n_chars == len("Three four five")


def test_a_line_that_goes_on(docs_of):
    line = words(0, 12)
    rows = [(1, "\n".join([line] * 10))]
    assert passages.remove_repeats(docs_of(rows)).first().text == line + "\n"


def test_passages_of_odd_rows(odd, odd_rows, no_rows):
    found = passages.repeated_passages(odd).collect()
    assert {(row.doc_id, row.source_doc_id) for row in found} >= {(8, 4)} or (8, 7) in {
        (row.doc_id, row.source_doc_id) for row in found
    }
    cut = passages.remove_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == len(odd_rows)
    assert passages.repeated_passages(no_rows).count() == 0 and passages.remove_repeats(no_rows).count() == 0


# ---- toxicity ---------------------------------------------------------------------------------------------------
def test_folding():
    assert toxicity.fold("You ІDІОТ, 1d10t! l0ser") == " you idiot idiot loser "
    assert toxicity.fold("ｉｄｉｏｔ") == " idiot "
    assert toxicity.fold("") == "  "
    for text in ("ïdïot", "i\u0301diot", "𝐢𝐝𝐢𝐨𝐭", "𝐈𝐃𝐈𝐎𝐓", "ⅰdiot", "id\u200biot", "i\u00addiot", "ìdíót", "IDİOT"):
        assert toxicity.fold(text) == " idiot ", text


def test_exceptions_in_one_sweep():
    entries = tuple((f" {word} ", weight) for word, weight in (("trash", 3.0), ("can", 1.0), ("pig", 2.0), ("iron", 4.0)))
    model = toxicity.Model(entries, toxicity.DEFAULT_CURVE, ("trash can", "guinea pig", "pig iron", "a guinea pig iron"))
    generator = random.Random(9)
    for _ in range(500):
        words = generator.choices(["trash", "can", "pig", "iron", "guinea", "a"], k=generator.randint(0, 14))
        folded = toxicity.fold(" ".join(words))
        spans = [
            (at, at + len(phrase) + 1) for phrase in model.exceptions for at in range(len(folded))
            if folded.startswith(f" {phrase} ", at)
        ]
        total = sum(
            weight for entry, weight in entries for at in range(len(folded))
            if folded.startswith(entry, at) and not any(start <= at < end for start, end in spans)
        )
        assert model.match(" ".join(words))[0] == total
    started = time.perf_counter()
    assert model.match("trash can " * 100_000) == (0.0, 200_000)
    assert time.perf_counter() - started < 10


def test_all_entries_over_the_weight_are_kept():
    counts = [(f" w{i} ", 200 + i % 3, 0) for i in range(9000)]
    assert len(toxicity.weights(counts, 1000, 1000)) >= 9000


def test_exceptions_and_length():
    model = toxicity.Model(((" trash ", 3.0), (" clow", 2.0)), (-3.0, 1.0, 0.5))
    assert model.match("put it in the trash can")[0] == 0
    assert model.match("trash and a trash can")[0] == 3
    assert model.match("clowning around")[0] == 2
    assert model.score("trash " + "x " * 10) > model.score("trash " + "x " * 2000) > model.score("")


def labelled(spark, docs_of, rows):
    docs = docs_of([(i, text) for i, text, _ in rows])
    return docs, spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")


def test_unseen_words_are_learnt(spark, docs_of):
    generator, rows = random.Random(3), []
    for i in range(900):
        text = generator.choices(WORDS[:300], k=40)
        toxic = int(generator.random() < 0.15)
        if toxic:
            text[generator.randrange(40)] = generator.choice(["zorgish", "zorgest", "blivet"])
        rows.append((i, " ".join(text), toxic))
    found = toxicity.detect(*labelled(spark, docs_of, rows)).collect()
    truth = {i: y for i, _, y in rows}
    held = [row for row in found if row.held_out]
    assert {row.doc_id for row in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([row.predicted == truth[row.doc_id] for row in held]) > 0.97
    assert sum(row.predicted for row in held if truth[row.doc_id]) > 0.9 * sum(truth[row.doc_id] for row in held)
    assert all(row.predicted == (row.score >= 0.3) and 0 <= row.score <= 1 for row in found)


def test_op7_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {row.doc_id: row.toxic for row in read_table(spark, sf_dir, "labels").collect()}
    rows = [r for r in registry()["op7_toxicity"](spark, sf_dir).collect() if r.held_out and r.doc_id in truth]
    toxic = [r for r in rows if truth[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    assert sum(r.predicted for r in rows if not truth[r.doc_id]) <= 0.05 * len(rows)


def test_toxicity_of_odd_rows(spark, odd, odd_rows, no_rows):
    labels = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        assert toxicity.detect(odd, some).count() == len(odd_rows)
        assert toxicity.detect(no_rows, some).count() == 0
        assert toxicity.keep_clean(odd, some).columns == odd.columns


# ---- search -----------------------------------------------------------------------------------------------------
def best(vectors, query, k):
    ids, parts = zip(*vectors)
    scores = [(-sum(a * b for a, b in zip(p, query[1])), i) for i, p in zip(ids, parts) if i != query[0]]
    return [(i, -s) for s, i in sorted(scores)[:k]]


@pytest.mark.parametrize("dims", [1, 3, 40])
def test_top_k_equals_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    generator = np.random.default_rng(dims)
    floats = np.round(generator.normal(size=(300, dims)), 1).astype(np.float32)
    floats[50:120] = floats[50]  # one very common vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(floats)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = [(i, np.floor(1024 * v.astype(np.float64)).astype(int).tolist()) for i, v in enumerate(floats)]
    found = defaultdict(list)
    for row in topk.top_k(frame.where("vec_id % 50 = 0"), frame).orderBy("query_id", "rank").collect():
        found[row.query_id].append((row.vec_id, row.score))
    assert sorted(found) == list(range(0, 300, 50))
    for query, got in found.items():
        assert got == best(whole, whole[query], 10)


def test_bounds_hold_at_every_level():
    generator = np.random.default_rng(8)
    a, b = generator.integers(-2000, 2000, (20, 37)), generator.integers(-2000, 2000, (30, 37))
    exact, before = a @ b.T, np.inf
    for level in topk.LEVELS:
        bound = topk.statistics(a, level) @ topk.statistics(b, level).T
        assert (bound >= exact - 1e-6 * np.abs(exact) - 1e-6).all()
        before = bound


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [2.0, 0.5]),
            (None, [9.0, 9.0]), (6, [3.0]), (7, []), (100, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, score string")
    found = topk.top_k(frame.where("vec_id % 100 = 0"), frame).collect()
    assert {row.vec_id for row in found if row.query_id == 0} == {5, 100}
    assert {row.vec_id for row in found if row.query_id == 100} == {0, 5}
    assert topk.top_k(frame.limit(0), frame).count() == 0 and topk.top_k(frame, frame.limit(0)).count() == 0


def test_repeated_vectors_count_once(spark):
    vectors = [(i, [float(i), 1.0]) for i in range(30)]
    frame = spark.createDataFrame(vectors * 3 + [(5, [5.0, 9.0])], "vec_id long, embedding array<float>")
    found = topk.top_k(frame.where("vec_id in (0, 5)"), frame).orderBy("query_id", "rank").collect()
    whole = [(i, [1024 * int(x) for x in v]) for i, v in vectors]
    for query in (0, 5):
        assert [(r.vec_id, r.score) for r in found if r.query_id == query] == best(whole, whole[query], 10)
        assert [r.rank for r in found if r.query_id == query] == list(range(1, 11))


def test_scores_beyond_64_bits_are_refused():
    large = np.array([[1 << 40, 1]] * 3)
    with pytest.raises(OverflowError):
        list(topk.best_of_block(large, np.arange(3), large, np.arange(3), 2))


# ---- pipeline ---------------------------------------------------------------------------------------------------
def test_pipeline_stages(spark, sf_dir, given):
    docs = read_table(spark, sf_dir, "documents")
    columns, kept = docs.columns, docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, sf_dir).collect(), docs.schema)
        assert kept.columns == columns, name
        sizes.append(kept.count())
        if name == "near_duplicates":
            unique = [(row.doc_id, row.text) for row in kept.collect()]
            assert all(i == g for i, g in groups(unique).items())
    assert len(given) > sizes[0] > sizes[1] == sizes[2]
    last = kept.collect()
    assert not any(any(mark) for mark in exact_repeats([(r.doc_id, r.text) for r in last], 60).values())
    assert all(row.n_chars == len(row.text) for row in last)
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {row.doc_id for row in packed.select("doc_id").distinct().collect()} == {row.doc_id for row in last}


def test_pipeline_of_odd_rows(spark, odd, no_rows, sf_dir):
    for frame in (odd, no_rows):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), frame.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).columns[:3] == ["doc_id", "start", "length"]
