"""Decontamination, repeated substrings, near duplicates, and the pipeline."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridquill.llm import components, decontam, neardup, suffix
from gridquill.llm.common import Scratch
from gridquill.llm.queries import QUERIES

from .cases import documents, empty

MEDIUM = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} - {""}


def plain_components(docs, percent=85):
    """By all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    seen = set()
    for own in holders.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def plain_removal(docs):
    seen, out = set(), {}
    for d, t in sorted(docs):
        raw = (t or "").encode()
        own = [raw[i : i + 50] for i in range(len(raw) - 49)]
        gone = bytearray(len(raw))
        for i, w in enumerate(own):
            if w in seen:
                gone[i : i + 50] = b"\1" * 50
        seen.update(own)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), sum(1 for i in range(len(raw)) if gone[i] and (not i or not gone[i - 1])), hashlib.sha256(kept).hexdigest())
    return out


def table(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def test_near_duplicates_against_all_pairs(spark):
    want = plain_components(table(spark, MEDIUM))
    got = {r.doc_id: r for r in QUERIES["op9_near_duplicates"](spark, MEDIUM).collect()}
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def variants(count, seed, size=120, vocabulary=5000):
    """A group around one text with edits of different strength, and rows that share a passage with it."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(vocabulary)}"
    base, passage = [word() for _ in range(size)], [word() for _ in range(40)]
    out = []
    for k in range(count):
        text = list(base)
        for i in rng.integers(0, size, int(rng.integers(0, 9))):
            text[i] = word()
        out.append((k, " ".join(text if k % 3 else passage + [word() for _ in range(int(rng.integers(5, 60)))])))
    return out


def test_groups_across_blocks_lose_no_link(spark, monkeypatch):
    docs = variants(400, 3)
    want = plain_components(docs)
    monkeypatch.setattr(neardup, "BLOCK", 50)
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), Scratch(spark, "t")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_blocks_are_bounded_in_bytes(spark):
    """24 MB of near copies are few documents, but more than one task gets."""
    base = [f"w{k:05d}" for k in range(57_000)]
    docs = spark.createDataFrame([(k, " ".join([*base[: 900 * k], f"own{k}", *base[900 * k :]])) for k in range(60)], "doc_id long, text string")
    scratch = Scratch(spark, "t")
    assert {r.component_id for r in neardup.near_duplicates(docs, scratch).collect()} == {0}
    texts = spark.read.parquet(f"{scratch.root}/*-texts").groupBy("comp", "own").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert sum(r.n for r in texts) > 23_000_000 and max(r.n for r in texts) < 16_000_000, texts


def test_comparing_copies_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 20_000).astype(np.uint64)
    sets = [np.unique(np.append(base[rng.random(20_000) > 0.02], rng.integers(0, 1 << 62, 400).astype(np.uint64))) for _ in range(200)]
    tracemalloc.start()
    try:
        found = neardup.links_among(np.arange(200), sets, np.zeros(200, int))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == 199 and peak < sum(s.nbytes for s in sets)


def test_links_do_not_depend_on_how_many_values_are_looked_at(monkeypatch):
    """Some sets link and some don't: the first neighbours and the index decide alike."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = [np.unique(np.append(base[rng.random(400) > drop], rng.integers(0, 1 << 62, 20).astype(np.uint64))) for drop in rng.random(80) * 0.12]
    linked = {(x, y) for x in range(80) for y in range(x) if 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))}
    assert 0 < len(linked) < 80 * 79 / 2

    def groups(pairs):
        root = list(range(80))
        for a, b in pairs:
            root = [root[b] if r == root[a] else r for r in root]
        return {frozenset(k for k in range(80) if root[k] == r) for r in root}

    for most in (1 << 20, 100, 1):
        monkeypatch.setattr(neardup, "HOLDERS", most)
        found = neardup.links_among(np.arange(80), sets, np.zeros(80, int))
        assert set(found) <= linked and groups(found) == groups(linked)


def test_similarity_is_a_parameter(spark):
    """Five pairs with 80 to 85 in 100 in common, small and large, are linked at 80 and not at 85."""
    rows = []
    for k, (n, drop) in enumerate([(4, 1), (20, 4), (60, 11), (200, 38), (1000, 180)]):
        words = [f"p{k}w{i}" for i in range(n + 4)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[: n + 4 - drop]))]
    rows = [r for r in rows if r[0] > 1] + [(0, "a b c d e f g h i"), (1, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, kept in ((80, 5), (85, 10)):
        assert neardup.deduplicate(docs, Scratch(spark, "t"), percent).count() == kept
        assert neardup.near_duplicates(docs, Scratch(spark, "t"), percent).where("kept").count() == kept
    assert neardup.bounds(85) == neardup.Bounds(85, 34, 54, 6) and neardup.bounds(80) == neardup.Bounds(80, 30, 51, 4)


def test_estimate_is_exact_for_small_sets():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 62, 40).astype(np.uint64))
    near = np.unique(np.append(base[:-2], rng.integers(0, 1 << 62, 2).astype(np.uint64)))
    far = np.unique(np.append(base[:-9], rng.integers(0, 1 << 62, 9).astype(np.uint64)))
    assert neardup.links_among(np.array([1, 2, 3]), [base, near, far], np.zeros(3, int)) == [(2, 1)]


def test_filters_before_the_full_sets_lose_no_link():
    """Linked large sets that share 36 of the union's 64 smallest, and sets of 63 with 58 in common, whose union has more than 64."""
    low, high = np.arange(100, dtype=np.uint64), np.arange(1000, 2000, dtype=np.uint64)
    a = np.concatenate([low[:50], high])
    b = np.concatenate([low[:36], low[50:64], high])
    assert neardup.links_among(np.array([1, 2]), [a, b], np.zeros(2, int)) == [(2, 1)]
    a = np.concatenate([low[:5], high[:58]])
    b = np.concatenate([low[5:10], high[:58]])
    assert neardup.links_among(np.array([1, 2]), [a, b], np.zeros(2, int)) == [(2, 1)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(50)]
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(got[200 + k] == 100 for k in range(50))


def test_near_duplicate_edges(spark):
    got = neardup.near_duplicates(documents(spark), Scratch(spark, "t")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[6][0].component_id == 1 and not by[6][0].kept and by[2][0].n_shingles == 0 and by[4][0].component_id == 4
    assert len(by[9]) == 2 and all(r.kept for r in by[9]) and by[None][0].component_id is None and by[None][0].kept
    assert neardup.near_duplicates(empty(spark), Scratch(spark, "t")).count() == 0
    kept = neardup.deduplicate(documents(spark), Scratch(spark, "t"))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "7", "8", "9", "None"]


def test_removal_against_plain_version(spark):
    docs = table(spark, "/root/testdata/sf0.001")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == plain_removal(docs)


def test_removal_across_bundles_and_hot_passages(spark, monkeypatch):
    rng = np.random.default_rng(2)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 6)))
    passage = " ".join(word() for _ in range(20))
    docs = [(int(k), " ".join([word() for _ in range(int(rng.integers(0, 30)))] + ([passage] if k % 3 == 0 else []) + [word() for _ in range(8)])) for k in rng.permutation(300)]
    docs += [(1000, docs[5][1]), (1001, "ab" * 400), (1002, "ab" * 300), (1003, "x" * 49), (1004, "x" * 49), (1005, docs[7][1][10:]), (1006, "é" * 60), (1007, "é" * 25), (-5, docs[9][1][:80])]
    want = plain_removal(docs)
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    for hot in (64, 2):
        monkeypatch.setattr(suffix, "HOT_BUNDLES", hot)
        monkeypatch.setattr(suffix, "BUNDLE_BYTES", 2000)
        found = suffix.remove_repeats(rows, Scratch(spark, "t")).collect()
        got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found}
        assert got == want
    for r in found:
        assert r.n_removed == sum(s.end - s.start for s in r.spans)


def test_settling_in_one_process(monkeypatch):
    """The passes without Spark, with bundles of a few texts and anchors counted hot."""
    rng = np.random.default_rng(4)
    shared = "".join(map(chr, rng.integers(97, 105, 200)))
    docs = [(k, shared[int(rng.integers(0, 60)) :][: int(rng.integers(0, 120))] + "".join(map(chr, rng.integers(97, 105, 70)))) for k in range(24)]
    want = plain_removal(docs)
    made, parts, secret = [], 3, suffix.new_secret()
    for a in range(0, 24, 4):
        own = docs[a : a + 4]
        raw = b"".join(t.encode() for _, t in own)
        lengths = np.array([len(t) for _, t in own], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        plain = np.frombuffer(raw, np.uint8)
        made.append(suffix.Bundle(np.array([d for d, _ in own]).tobytes(), np.ones(4, bool).tobytes(), lengths.tobytes(), suffix.zstandard.compress(raw), suffix.packed_runs(plain, offsets), parts, secret))

    def settled(send, settle):
        answers = [{} for _ in made]
        for part in range(parts):
            found = [(k, blob) for k, b in enumerate(made) for p, blob in send(b, k) if p == part]
            for (k, _), answer in zip(found, settle([b for _, b in found]) if found else [], strict=True):
                if answer is not None:
                    answers[k][part] = answer
        return answers

    first = settled(lambda b, k: b.anchors(), suffix.settle_anchors)
    for b, known in zip(made, first, strict=True):
        b.contexts(known)
    monkeypatch.setattr(suffix, "WINDOWS_AT_ONCE", 40)
    second = settled(lambda b, k: b.digests(), suffix.settle_digests)
    third = settled(lambda b, k: b.asked(second[k]), suffix.settle_contexts)
    for k, b in enumerate(made):
        gone = b.marks([*second[k].items(), *third[k].items()])
        for d, i, j in zip(b.ids, b.offsets, b.offsets[1:], strict=False):
            assert (j - i, gone[i:j].sum()) == want[int(d)][:2]


def test_digests_tell_crafted_contexts_apart():
    """Contexts that a sum with known multipliers can't tell apart differ under keys of the run; equal ones agree."""
    a = np.array([[1, 0, 3], [0, 1, 3], [1, 0, 3]], np.uint64)
    for _ in range(50):
        keys = suffix.new_secret()[:, :7]
        high, low = suffix.strong_digests(a, keys)
        assert high[0] == high[2] and low[0] == low[2] and (high[0], low[0]) != (high[1], low[1])


def test_radix_passes_group_equal_rows():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    got = suffix.radix_classes(rows)
    for k in range(500):
        assert got[k] == np.flatnonzero((rows == rows[k]).all(1))[0]


def test_removal_edges(spark):
    got = suffix.remove_repeats(documents(spark), Scratch(spark, "t")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == 11 and by[6][0].n_removed == by[6][0].n_bytes > 0 and by[1][0].n_removed == 0 and by[5][0].n_removed == 0 and by[2][0].n_bytes == 0
    assert by[None][0].n_removed == 0 and [r.n_removed for r in by[9]] == [0, 0]
    assert suffix.remove_repeats(empty(spark), Scratch(spark, "t")).count() == 0


def plain_windows(text):
    return [re.sub(r"[^\w]", "", w).lower() for w in (text or "").split()]


def test_leaks_against_plain_version(spark):
    """All items whose words stand in a document in one piece are found, and no others than near ones."""
    items = {r.item_id: " ".join(plain_windows(r.text)) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()}
    docs = {d: " ".join(plain_windows(t)) for d, t in table(spark, MEDIUM)}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op2_decontamination"](spark, MEDIUM).collect()}
    assert want and got == want


QUESTION = "Alice bought 3 apples for 2 dollars each and gave Bob 3 pears, how much did Alice pay?"


@pytest.mark.parametrize(
    ("text", "hit"),
    [
        (QUESTION, True), ("so: " + QUESTION.upper() + " end", True), ("Carol bought 7 apples for 9 dollars each and gave Dan 7 pears, how much did Carol pay?", True),
        ("Carol bought 7 apples for 9 dollars each and gave Dan 8 pears, how much did Eve pay?", False), ("Élodie bought twelve apples for 5 euros each and gave Dan twelve pears, how much did Élodie pay?", True),
        ("apples and pears for Alice and Bob", False), (None, False), ("", False), ("tiny one", True), ("tiny one and more words", False),
    ],
)
def test_parameters_of_a_question(text, hit, spark):
    b = spark.createDataFrame([(1, QUESTION), (2, "tiny one"), (3, None), (4, "")], "item_id long, text string")
    for doc_id in (5, None):
        d = documents(spark, [(doc_id, text, None, None)])
        assert (decontam.contamination(d, b, Scratch(spark, "t")).count() == 1) == hit
    assert decontam.decontaminate(d, b, Scratch(spark, "t")).count() == (0 if hit else 1)


SHORT = [(1, "Paris"), (2, "42"), (3, "What is 12 + 7 ? 19"), (4, "York New York 12 Boston 13"), (5, "Name the capital of France: Paris")]


SHORT_CASES = [
    ("London", set()), ("1999", set()), ("Paris", {1}), ("I saw Paris in 42 days", set()), ("so tell me: what is 12 + 7? 19, of course", {3}), ("what is 13 + 7 ? 20 that is", set()), ("42", {2}),
    ("we saw York, New York: 12, Boston 13", {4}), ("we saw New York York 12 Boston 13", set()), ("Name the capital of France: Paris", {5}), ("x Name the capital of Spain: Madrid y", {5}),
    ("What is 3 + 4 ? 7", {3}), ("where is 3 + 4 ? 7", set()),
]


def test_short_items(spark):
    b = spark.createDataFrame(SHORT, "item_id long, text string")
    d = documents(spark, [(k, text, None, None) for k, (text, _) in enumerate(SHORT_CASES)])
    got = {}
    for r in decontam.contamination(d, b, Scratch(spark, "t")).collect():
        got.setdefault(r.doc_id, set()).add(r.item_id)
    assert {k: got.get(k, set()) for k in range(len(SHORT_CASES))} == {k: items for k, (_, items) in enumerate(SHORT_CASES)}


NAMES = "Anna Boris Clara David Emil Frida Georg Hanna".split()
VERBS = "buys sells paints carries counts washes folds lends drops finds".split()
THINGS = "apples stones books ropes plates shirts lamps nails coins shells".split()


def story(rng, verbs, things, names, numbers):
    """A question over two people and three numbers; each value stands in two places at least."""
    a, b = names
    x, y, z = numbers
    return (
        f"Every morning {a} {verbs[0]} {x} {things[0]} and then {a} {verbs[1]} {y} {things[1]} for {b} . Later {b} {verbs[2]} {z} {things[0]} , "
        f"so {b} still {verbs[3]} {x} {things[2]} while {a} {verbs[4]} {y} {things[3]} . How many {things[4]} do {a} and {b} have after {z} days ?"
    )


def test_templates_against_a_plain_version(spark):
    """Items with other names and numbers, copies with inserted words, shuffled slots, and unrelated questions."""
    rng = np.random.default_rng(11)
    items, docs, planted = [], [], {}
    for i in range(25):
        verbs, things = list(rng.permutation(VERBS)), list(rng.permutation(THINGS))
        make = lambda names, numbers: story(rng, verbs, things, names, numbers)  # noqa: E731, B023
        own = make(list(rng.permutation(NAMES)[:2]), [int(v) for v in rng.choice(np.arange(2, 90), 3, replace=False)])
        items.append((i, own))
        other = make(["Zora", "Yuri"], [int(v) for v in rng.choice(np.arange(100, 900), 3, replace=False)])
        words = other.split()
        words.insert(20, "really")
        shuffled = [str(int(rng.integers(1000, 9999))) if w.isdigit() else ("Q" + str(k) + "x" if w[:1].isupper() else w) for k, w in enumerate(other.split())]
        shuffled = [w if not (w.startswith("Q") and w.endswith("x")) else "Name" + chr(97 + k % 26) + chr(97 + k // 26) for k, w in enumerate(shuffled)]
        for kind, text in (("same", own), ("other", other), ("inserted", " ".join(words)), ("shuffled", " ".join(shuffled))):
            planted[len(docs)] = (kind, i)
            docs.append((len(docs), f"some text before it . {text} and after"))
    got = {(r.doc_id, r.item_id) for r in decontam.contamination(documents(spark, [(d, t, None, None) for d, t in docs]), spark.createDataFrame(items, "item_id long, text string"), Scratch(spark, "t")).collect()}
    assert got == plain_contamination(docs, items)
    assert all(((d, i) in got) == (kind != "shuffled") for d, (kind, i) in planted.items())


NUMBERS, UNITS = set(decontam.NUMBER_WORDS), set(decontam.UNIT_WORDS)


def plain_tokens(text):
    """(word, type) by rules written down again, one word at a time."""
    found = re.findall(r"\d+(?:[.,]\d+)*|[%$]+|[^\s\d!-/:-@\[-`{-~]+", text or "")
    kinds = []
    for w in found:
        upper = "A" <= w[0] <= "Z" and len(w.encode()) > 1 and not "A" <= w[1:2] <= "Z" or "À" <= w[0] <= "Þ"
        kinds.append("N" if w[0].isdigit() or w.lower() in NUMBERS else "P" if upper else "")
    for k, w in enumerate(found):
        if kinds[k] != "N" and w.lower() in UNITS and "N" in (kinds[k - 1 : k] + kinds[k + 1 : k + 2]):
            kinds[k] = "U"
    return [w.lower() for w in found], kinds


def plain_template(text, names):
    words, kinds = plain_tokens(text)
    out = []
    for w, k in zip(words, kinds, strict=True):
        k = "" if k == "P" and not names else k
        if k and out and out[-1][0] == k:
            out[-1] = (k, (*out[-1][1], w))
        else:
            out.append((k, (w,)))
    return out


def plain_windows_of(t):
    shape = [(k, None if k else v) for k, v in t]
    if len(t) < 5:
        return {0: tuple(shape)} if sum(not k for k, _ in t) >= 2 else {}
    return {p: tuple(shape[p : p + 5]) for p in range(len(t) - 4) if sum(not k for k, _ in t[p : p + 5]) >= 2}


def plain_consistent(found):
    """found: set of (item position, ((slot, item value, value), ...)); windows left."""
    slots = {b for _, bound in found for b in bound}
    count = {}
    for _, i, d in slots:
        count[i, d] = count.get((i, d), 0) + 1
    held = set()
    for i, d in count:
        rivals = [(e, n) for (j, e), n in count.items() if j == i and e != d]
        if i == d or not any(e == i or n >= count[i, d] for e, n in rivals):
            held.add((i, d))
    return {w for w in found if all((i, d) in held for _, i, d in w[1])}


def plain_contamination(docs, items):
    """Items of five template tokens or more, by all pairs."""
    out = set()
    for names in (False, True):
        made = {i: (t := plain_template(x, names), plain_windows_of(t)) for i, x in items}
        for d, text in docs:
            td = plain_template(text, names)
            wd = plain_windows_of(td)
            for i, (ti, wi) in made.items():
                by = {}
                for p, h in wi.items():
                    for q, g in wd.items():
                        if g == h:
                            bound = tuple((p + k, ti[p + k][1], td[q + k][1]) for k in range(len(h)) if h[k][0])
                            by.setdefault(q - p, set()).add((p, bound))
                groups, last = [], None
                for diagonal in sorted(by):
                    if last is None or diagonal - last > decontam.GAP:
                        groups.append(set())
                    groups[-1] |= by[diagonal]
                    last = diagonal
                groups.append(set().union(*groups))
                if wi and max(len({p for p, _ in plain_consistent(g)}) for g in groups) >= 0.5 * len(wi):
                    out.add((d, i))
    return out


def test_parts_of_an_item_must_agree(spark):
    """Two halves of a question with different names and numbers don't add up; with the same ones they do."""
    rng = np.random.default_rng(0)
    item = story(rng, VERBS, THINGS, ["Anna", "Boris"], [3, 5, 7])
    one, two = story(rng, VERBS, THINGS, ["Zora", "Yuri"], [11, 13, 17]).split(), story(rng, VERBS, THINGS, ["Vera", "Karl"], [21, 23, 29]).split()
    cut, filler = len(one) // 2, "and now something that has nothing to do with any of this at all for a while".split()
    texts = [(1, one[:cut] + filler + one[cut:]), (2, one[: cut - 6] + filler + two[cut + 6 :])]
    d = documents(spark, [(k, " ".join(t), None, None) for k, t in texts])
    got = {r.doc_id for r in decontam.contamination(d, spark.createDataFrame([(1, item)], "item_id long, text string"), Scratch(spark, "t")).collect()}
    assert got == {d for d, _ in plain_contamination([(k, " ".join(t)) for k, t in texts], [(1, item)])} and 1 in got and 2 not in got


def test_one_changed_number_hides_no_copy(spark):
    """A value that the item has twice, changed in one place only, drops just the windows of that place."""
    b = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    d = documents(spark, [(1, QUESTION.replace("3 pears", "4 pears"), None, None), (2, QUESTION, None, None)])
    got = {r.doc_id: r for r in decontam.contamination(d, b, Scratch(spark, "t")).collect()}
    assert set(got) == {1, 2} and got[2].windows / 2 <= got[1].covered < got[2].covered == got[2].windows and not got[1].reparameterised
    assert decontam.decontaminate(d, b, Scratch(spark, "t")).count() == 0


def test_windows_without_broadcast(spark, monkeypatch):
    """Beyond the bound all windows are joined by a shuffle, with the same result."""
    b = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    d = documents(spark, [(1, "x " * 50 + QUESTION, None, None), (2, "nothing of it", None, None)])
    a = decontam.contamination(d, b, Scratch(spark, "t")).collect()
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert decontam.contamination(d, b, Scratch(spark, "t")).collect() == a and len(a) == 1
    assert decontam.contamination(empty(spark), b, Scratch(spark, "t")).count() == 0
    assert decontam.contamination(d, b.limit(0), Scratch(spark, "t")).count() == 0


def test_pipeline_stages_against_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, scratch = docs.columns, Scratch(spark, "t")
    state, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = state
        state = scratch.table(stage(spark, state, small), name)
        kept[name] = (before.collect(), state.collect(), state.columns)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixture", "shards"]
    assert all(kept[n][2] == columns for n in list(kept)[:-1])
    old, new, _ = kept["language"]
    assert len(new) >= 0.98 * len(old)
    old, new, _ = kept["near_duplicates"]
    want = plain_components([(r.doc_id, r.text) for r in old], 80)
    assert {r.doc_id for r in new} == {d for d, (_, c) in want.items() if d == c}
    old, new, _ = kept["decontamination"]
    items = [" ".join(plain_windows(r.text)) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert {r.doc_id for r in new} == {r.doc_id for r in old if not any(x in " ".join(plain_windows(r.text)) for x in items)}
    old, new, _ = kept["mixture"]
    assert {r.doc_id for r in new} <= {r.doc_id for r in old} and abs(sum(len(WORD.findall(r.text)) for r in new) / sum(len(WORD.findall(r.text)) for r in old) - 1) < 0.25
    old, new, _ = kept["shards"]
    assert len(new) == len(old) and {r.shard for r in new} <= set(range(40))


@pytest.mark.parametrize("make", [documents, empty])
def test_pipeline_edges(make, spark, small, tmp_path):
    d = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, small)
        d.write.parquet(f"{tmp_path}/{name}")
        d = spark.read.schema(d.schema).parquet(f"{tmp_path}/{name}")
    assert d.count() <= 33
