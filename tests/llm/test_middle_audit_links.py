"""Skip lists, fill-in-middle texts, posting lists, the filter audit and embedding links against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallylake.llm import embedding_links, fill_in_middle, filter_audit, postings
from tallylake.llm.skip_list import SkipList, unit_widths

ids = st.sets(st.integers(0, 60)).map(sorted)


@given(st.lists(st.integers(1, 400), max_size=2000), st.data())
@settings(max_examples=60, deadline=None)
def test_skip_list_ranks(widths, data):
    units = SkipList(np.array(widths, np.int64))
    for rank in {0, len(widths), data.draw(st.integers(0, len(widths)))}:
        assert units.code_points(rank) == sum(widths[:rank])
    with pytest.raises(IndexError):
        units.code_points(len(widths) + 1)


def test_skip_list_of_a_long_text_meets_few_links():
    text = "日本 語🙂x" * 400_000
    units = SkipList(unit_widths(text))
    assert units.units == len(text) and len(units.lanes) == 6
    for rank in (0, 1, 15, 16, 17, 4096, 65_537, len(text) - 1, len(text)):
        assert units.code_points(rank) == rank


@given(st.text(alphabet="ab \n🙂", max_size=60))
def test_units_tile_the_text(text):
    for pattern in (None, re.compile(r"\S+\s*"), re.compile("\n"), re.compile("x*")):
        widths = unit_widths(text, pattern)
        assert widths.sum() == len(text) and (widths > 0).all()


def test_texts_rearranged_and_restored(spark):
    rng = random.Random(5)
    texts = ["", None, "x", "<", "S>", "a<S", "<P", "has <M> in it", "naïve 日本語 🙂\x00", "word " * 30_000]
    texts += ["".join(rng.choices("ab <>SPM\né🙂", k=rng.randrange(1, 40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for seed, unit in ((1, None), (7, r"\S+\s*")):
        made = fill_in_middle.transformed(docs, seed=seed, unit=unit)
        rebuilt = fill_in_middle.restored(made["output"], made["form"]).alias("back")
        forms = set()
        for r in made.select("*", rebuilt).collect():
            text = texts[r.doc_id] or ""
            units = [] if not text else ["x"] * len(text)
            if unit and text:
                cuts = [m.end() for m in re.finditer(unit, text)][:-1]
                units = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
            assert r.back == text and r.n == len(units)
            digest = hashlib.sha256(f"{seed}:{r.doc_id}".encode()).hexdigest()
            h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
            marks = any(m in text for m in ("<P>", "<S>", "<M>"))
            form = "plain" if not text or marks or h[2] % 100 >= 90 else "spm" if h[3] % 100 < 20 else "psm"
            assert r.form == form
            forms.add(form)
            if form == "plain":
                assert r.output == text and r.prefix_chars is None and r.middle_chars is None
                continue
            low, high = sorted((h[0] % (r.n + 1), h[1] % (r.n + 1)))
            parts = [units[:low], units[low:high], units[high:]]
            a, m = (sum(map(len, p)) for p in parts[:2])
            assert (r.prefix_chars, r.middle_chars) == (a, m)
            prefix, middle, suffix = text[:a], text[a : a + m], text[a + m :]
            if form == "psm":
                assert r.output == f"<P>{prefix}<S>{suffix}<M>{middle}"
            else:
                assert r.output == f"<S>{suffix}<P>{prefix}<M>{middle}"
        assert forms == {"plain", "psm", "spm"}


@given(st.lists(ids, max_size=5))
def test_galloping_union(lists):
    assert postings.union(lists) == sorted(set().union(*lists))


@given(ids, ids)
def test_galloping_difference_and_common(a, b):
    assert postings.difference(a, b) == sorted(set(a) - set(b))
    assert postings.common(a, b) == len(set(a) & set(b))


def test_gallop_copies_runs():
    long, short = list(range(0, 200_000, 2)), [99_999, 150_001]
    assert postings.union([long, short]) == sorted(long + short)
    assert postings.gallop(long, 0, 99_999) == 50_000


def audited(rows, labels):
    """The audit's rows from sets of ids, order by order."""
    texts, fails, parts = {}, {}, {}
    for doc_id, text, source in rows:
        text = text or ""
        texts.setdefault(text, []).append(doc_id)
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            failed.add("C")
        if re.search(r"[#$%&*|]", text):
            failed.add("D")
        if any(other < doc_id for other in texts[text]):
            failed.add("E")
        parts.setdefault(source or "", set()).add(doc_id)
        fails[doc_id] = failed
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, bad in labels if bad == 1}
    out = {}
    for part, members in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = set(members)
            for step, name in enumerate(order, 1):
                failing = {i for i in members if name in fails[i]}
                removed = failing & left
                left -= removed
                shapley[name] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), len(failing - removed), len([i for i in failing if fails[i] == {name}]),
                    len(removed & good), len(removed & toxic), name,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {key: tuple(row) for key, row in out.items()}


def test_audit_of_every_order(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE_IDS", 50)  # several ranges a part
    rng = random.Random(3)
    rows = []
    for i in range(260):
        words = rng.choices([f"w{k}" for k in range(rng.choice((40, 400)))], k=rng.choice((10, 199, 200, 320)))
        text = " ".join(words)
        if rng.random() < 0.3:
            text = text.upper() if rng.random() < 0.5 else "Ab" + text
        if rng.random() < 0.3:
            text += rng.choice("#$%&*|")
        if i and rng.random() < 0.3:
            text = rng.choice(rows)[1]
        rows.append((i * 3, text, rng.choice((None, "", "hot", "hot", "hot", "src"))))
    rows += [(9001, None, "hot"), (9002, "", "lone"), (-5, "", "lone"), (9003, "AB" + "c" * 98, "lone")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 700, 2)] + [(12345, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        )
        for r in filter_audit.audit(docs, marks).collect()
    }
    assert got == audited(rows, labels)


def test_posting_lists_are_sorted_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE_IDS", 100)
    docs = spark.range(1000).selectExpr("id as doc_id", "'few words' as text", "'hot' as source")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lists = filter_audit.posting_lists(filter_audit.verdicts(docs), labels).collect()
    assert {r.list for r in lists} == {"every", "A", "E"}
    for r in lists:
        assert r.ids == sorted(set(r.ids)) and {i // 100 for i in r.ids} == {r.id_range}
    assert sum(len(r.ids) for r in lists if r.list == "E") == 999


def brute_links(vectors, threshold):
    """(links, smallest reachable position) of the rows of a matrix."""
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    smallest = np.arange(len(vectors))
    while True:
        best = np.where(near, smallest[None, :], len(vectors)).min(axis=1)
        best = np.minimum(smallest, best)
        if (best == smallest).all():
            return near.sum(axis=1), smallest
        smallest = best


@pytest.mark.parametrize(("dims", "threshold", "element"), [(16, 0.95, "float"), (40, 0.9, "double"), (2, 0.999, "float")])
def test_links_match_all_pairs(spark, dims, threshold, element):
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(25, dims))
    # groups of every tightness, chains, exact and scaled copies, and vectors alone
    spread = rng.choice([0.05, 0.2, 0.25, 1.0], 1500)[:, None]
    vectors = centres[rng.integers(0, 25, 1500)] + rng.normal(size=(1500, dims)) * spread
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 200, 0), vectors[1:60] * 4])
    vectors = vectors.astype(np.float32).astype(float)
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{element}>").repartition(6)
    got = embedding_links.grouped(table, threshold=threshold, block_bytes=1, fanout=2).collect()
    n_links, component = brute_links(vectors, threshold)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (int(n_links[i]), int(component[i]), bool(component[i] == i)) for i in range(len(rows))
    }


def test_far_blocks_never_meet(spark):
    rng = np.random.default_rng(0)
    # two narrow cones in opposite directions: blocks of one never need those of the other
    cone = np.eye(1, 8) + rng.normal(size=(3000, 8)) * 0.01
    vectors = np.concatenate([cone, -cone])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    keyed, dtype = embedding_links.keyed(table, "vec_id", "embedding")
    classes = keyed.selectExpr("key", "vec_id as node", "1L as members", "vector")
    grid = embedding_links.fitted(classes, dtype, 0.95)
    packed = embedding_links.blocks(embedding_links.sequence(classes, grid), grid, 1)
    pairs = {(r.i, r.j) for r in embedding_links.block_pairs(packed, grid, 3).collect()}
    count = packed.count()
    assert count == 12 and {(k, k) for k in range(count)} <= pairs
    assert len(pairs) <= 6 * 7 + 6  # all pairs would be 78


def test_one_of_each_group_stays(spark):
    rows = [(5, [1.0, 0.0], "a"), (5, [1.0, 0.0], "a"), (7, [1.0, 0.01], "b"), (9, [0.0, 1.0], "c"), (None, [1.0, 0.0], "d")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, members string")
    kept = embedding_links.without_duplicates(table)
    assert kept.columns == table.columns
    assert sorted(r.members for r in kept.collect()) == ["a", "a", "c", "d"]
