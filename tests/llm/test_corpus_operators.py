"""The ten operators against brute force on hand-made rows."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallylake.llm import (
    decontamination,
    licenses,
    link_graph,
    mixing,
    near_duplicates,
    private_data,
    quality,
    suffix_tree,
    tokens,
    toxicity,
)
from tallylake.llm.components import components
from tallylake.llm.words import lower_word_hashes, lower_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re", "sal") for b in ("n", "ra", "lo", "vis", "dek", "mu")]


def documents(spark, texts, sources=None):
    rows = [
        (i, text, "en", sources[i] if sources else f"s{i % 3}", len(text or ""))
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def prose(n, seed):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


ODD = [None, "", " \t\n", "one", "One  one\x0bONE", "naïve É x", "日本語 テキスト。\n\n日本語", "a\x00b c", "🙂 " * 40]


def test_base_scores_match_counting_by_hand(spark):
    texts = ODD + [prose(5 + i % 40, i) for i in range(120)]
    docs = documents(spark, texts)
    tree, counts = suffix_tree.train(docs)
    got = {r.doc_id: r for r in suffix_tree.score(docs, tree, counts).collect()}
    tokenised = {i: words_of(lower(t)) + [None] for i, t in enumerate(texts)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokenised}
    seen = Counter(w for i, ws in tokenised.items() if not held[i] for w in ws)
    total = sum(seen.values())
    assert len(got) == len(texts) and any(held.values())
    for i, ws in tokenised.items():
        base = sum(math.log10((seen[w] + 1) / (total + len(seen) + 1)) for w in ws)
        row = got[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (
            held[i], len(ws), sum(seen[w] > 0 for w in ws), total,
        )
        assert row.base_score == pytest.approx(base, abs=1e-9)
        assert row.score <= 0


def test_the_suffix_tree_uses_longer_contexts(spark):
    texts = ["ka lo mi " * 30 if i % 2 else "mi lo ka " * 30 for i in range(60)]
    docs = documents(spark, texts)
    tree, counts = suffix_tree.train(docs)
    rows = suffix_tree.score(docs, tree, counts).collect()
    assert any(level.kept.any() for level in tree.levels)
    assert all(r.score > r.base_score + 10 for r in rows if r.held_out)


def learned_by_hand(texts, depth):
    """The chance function of the tree over ``texts``, by dictionaries and longest kept suffixes."""
    tokens = [words_of(lower(t)) + [None] for t in texts]
    seen = [Counter(tuple(ws[i : i + k + 1]) for ws in tokens for i in range(len(ws) - k)) for k in range(depth + 1)]
    total = sum(seen[0].values())
    follow = {}
    for k in range(1, depth + 1):
        for gram, n in seen[k].items():
            if n >= 2:
                follow.setdefault(gram[:-1], {})[gram[-1]] = n

    def direct(context, word):
        if not context:
            return (seen[0][(word,)] + 1) / (total + len(seen[0]) + 1)
        n = seen[len(context) - 1][context]
        rest = 1 - sum(x - 0.75 for x in follow[context].values()) / n
        own = follow[context].get(word)
        return max(0, (own or 0) - 0.75) / n + rest * direct(context[1:], word) if own else None

    def gain(c):
        cost = 0.5 * math.log(total)
        return sum(n * math.log(direct(c, w) / direct(c[1:], w)) - cost for w, n in follow[c].items())

    kept = {c for c in follow if gain(c) > 0}
    kept |= {c[k:] for c in kept for k in range(1, len(c))}

    def log_chance(context, word):
        while context and context not in kept:
            context = context[1:]
        if not context or word in follow[context]:
            return math.log10(direct(context, word))
        rest = 1 - sum(x - 0.75 for x in follow[context].values()) / seen[len(context) - 1][context]
        return math.log10(rest) + log_chance(context[1:], word)

    return lambda text: sum(
        log_chance(tuple(ws[max(0, i - depth) : i]), w)
        for ws in [words_of(lower(text)) + [None]]
        for i, w in enumerate(ws)
    )


@pytest.mark.parametrize("head, depth", [(500_000, 2), (9, 2), (500_000, 3), (9, 3)])
def test_scores_match_a_tree_of_dictionaries(spark, monkeypatch, head, depth):
    monkeypatch.setattr(suffix_tree, "HEAD", head)  # few values sent, the others joined
    texts = ODD + [prose(3 + i % 30, i % 25) + " ka " + prose(4, i) for i in range(150)]
    docs = documents(spark, texts)
    rows = suffix_tree.score(docs, *suffix_tree.train(docs, depth=depth)).collect()
    by_hand = learned_by_hand([texts[r.doc_id] for r in rows if not r.held_out], depth)
    for r in rows:
        assert r.score == pytest.approx(by_hand(texts[r.doc_id]), abs=1e-8), texts[r.doc_id]


@pytest.mark.parametrize("slot_bits", [12, 20])
def test_shared_slots_lose_nothing(spark, monkeypatch, slot_bits):
    monkeypatch.setattr(suffix_tree, "SLOT_BITS", slot_bits)  # 12: sequences share slots
    monkeypatch.setattr(suffix_tree, "SLOTS_A_BYTE", 64.0)
    monkeypatch.setattr(suffix_tree, "HELD", 300)  # counts from many parts of a task
    texts = [prose(600 + i % 30, i % 40) + f" alone{i} word{i}" for i in range(80)]
    docs = documents(spark, texts)
    tree, counts = suffix_tree.train(docs)
    full = np.unpackbits(tree.repeated[1].view(np.uint8)).mean()
    assert full > 0.9 if slot_bits == 12 else full < 0.1
    rows = suffix_tree.score(docs, tree, counts).collect()
    tree.discard()
    by_hand = learned_by_hand([texts[r.doc_id] for r in rows if not r.held_out], 2)
    for r in rows:
        assert r.score == pytest.approx(by_hand(texts[r.doc_id]), abs=1e-8)


def test_packed_sequences_add_up_to_their_counts():
    draw = np.random.default_rng(5)
    words = draw.integers(0, 1 << 64, 4000, np.uint64)
    pairs = words[draw.zipf(1.2, (60_000, 2)) % 4000]
    expected = Counter(map(tuple, pairs.tolist()))
    pieces = []
    for part in np.array_split(pairs, 3):
        keys, at, n = np.unique(suffix_tree.sequence_key(part[:, 0], part[:, 1]), return_index=True, return_counts=True)
        packed = suffix_tree.pack(keys, np.ascontiguousarray(part[at, 0]), n)
        assert len(packed) < 12 * len(keys)  # two hashes and a count
        pieces.append({"level": 1, "bucket": 0, "count": len(keys), "packed": packed})
    rows = suffix_tree._added_up(pa.Table.from_pylist(pieces)).to_pylist()
    got = {(r["context"] % (1 << 64), r["suffix"] % (1 << 64)): r["n"] for r in rows}
    assert len(got) == len(rows) and got == {k: n for k, n in expected.items() if n > 1}


def test_words_hashed_together_are_those_hashed_one_by_one():
    draw = random.Random(11)
    pieces = [b" ", b"\t", b"\r\x0c", b"Ab", b"\x00", "É日".encode()] + [b"x" * n for n in (1, 7, 8, 9, 16, 17, 64, 65, 500)]
    texts = [None if t is None else t.encode() for t in ODD] + [b"a", b"a\x00", b" a ", b"A"]
    texts += [b"".join(draw.choices(pieces, k=draw.randrange(200))) for _ in range(300)]
    hashes, counts = lower_word_hashes(texts)
    words = [lower_words(text) for text in texts]
    assert counts.tolist() == [len(own) for own in words]
    pairs = set(zip([w for own in words for w in own], hashes.tolist()))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    assert all(lower_word_hashes([w])[0].tolist() == [h] for w, h in list(pairs)[:500]) and max(hashes) < 1 << 63


def test_slots_are_packed_and_hashes_found_again():
    draw = np.random.default_rng(7)
    slots = np.unique(draw.integers(0, 1 << 22, 5000, np.uint64))
    twice = draw.random(len(slots)) < 0.2
    packed = suffix_tree.pack_slots(slots, twice)
    got, again = suffix_tree.unpack_slots(len(slots), packed)
    assert (got == slots).all() and (again == twice).all()
    assert len(packed) < 2 * len(slots)
    codes = np.unique(np.append(draw.integers(0, 1 << 64, 3000, np.uint64), np.arange(1 << 40, (1 << 40) + 50, dtype=np.uint64)))
    wanted = np.append(codes[::-3], draw.integers(0, 1 << 64, 1000, np.uint64))
    known = {c: k for k, c in enumerate(codes.tolist())}
    assert suffix_tree.Places(codes).of(wanted).tolist() == [known.get(w, -1) for w in wanted.tolist()]
    assert suffix_tree.Places(codes[:0]).of(wanted).max() == -1


def test_a_passage_is_learned_however_large_the_corpus(spark):
    passage = " ".join(f"rare{k}" for k in range(40))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = next(i for i in range(60) if i not in ids)
    rows = [(i, passage if k < 3 else "go " * 100_000) for k, i in enumerate(ids[:33])] + [(held, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_tree.score(docs, *suffix_tree.train(docs)).filter(f"doc_id = {held}").first()
    assert got.train_tokens > 3_000_000 and got.score > got.base_score + 100


def test_chances_of_a_context_sum_to_at_most_one(spark):
    docs = documents(spark, [prose(80, i) for i in range(60)])
    tree, _ = suffix_tree.train(docs)
    chance = (tree.counts + 1) / tree.mass
    level = tree.levels[0]
    for context in range(len(tree.counts)):
        own = level.context == context
        rest = 10 ** level.log_rest[context]
        known = set((level.codes[own] % tree.base).tolist())
        left = sum(c for k, c in enumerate(chance) if k not in known)
        assert (10 ** level.log_chance[own]).sum() + rest * left <= 1 + 1e-9


def test_token_counts_equal_the_library(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(
        str(public_tokenizers.path("byte_bpe_50k.json"))
    )
    texts = ODD + [
        "<|endoftext|> inside <|endoftext|>", "don't they'll I'VE", "x" * 5000, " " * 900 + "y", "12345 6,789\r\n\t ok ",
        "áé ​﻿", prose(3000, 1), "ÀÈ" * 700, "!?" * 800,
    ]
    got = {r.doc_id: r for r in tokens.token_counts(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        count = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (
            len((text or "").encode()), count, count > 512,
        ), text


def test_benchmark_copies_are_found_and_others_are_not(spark):
    item = prose(40, 900)
    edited = item.split()
    edited[7], edited[21] = "changed", "words"
    del edited[30]
    texts = [prose(60, 1) + " " + item + " " + prose(60, 2), prose(30, 3) + " " + " ".join(edited).upper()]
    texts += ["unrelated text about nothing at all " * 20, None, "", prose(100, 4)]
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, "x")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontamination.contaminated(docs, bench).filter("item_id = 7").collect()}
    assert set(rows) == {0, 1}
    assert rows[0].similarity == 1.0 and (rows[0].first_word, rows[0].end_word) == (60, 100)
    assert rows[1].similarity < 1.0
    left = decontamination.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {2, 3, 4, 5}


def full_alignment(item, words):
    """Smith-Waterman over the whole text, cell by cell, as a share of a full copy's score."""
    best, above = 0, [0] * (len(words) + 1)
    for x in item:
        row = [0]
        for j, y in enumerate(words):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best / (2 * len(item))


@pytest.mark.parametrize("clean", [0, 1, 300])
def test_edited_benchmark_copies_match_full_alignment(spark, clean):
    rng = random.Random(clean)
    items = [[f"w{rng.randrange(3000)}" for _ in range(n)] for n in (40, 40, 23, 9, 8, 5)]
    items.append(prose(40, 71).split())  # of common words
    bodies = []
    for item in items:
        for step in (2, 3, 4, 5, 6):
            for edit in (["changed"], [], ["put", "in"]):
                copy = [w for k, x in enumerate(item) for w in (edit if k % step == step - 1 else [x])]
                bodies.append(copy)
            bodies.append([w for k, x in enumerate(item) for w in ([x, "in"] if k % step == 0 else [x])])
        bodies.append(item[: len(item) // 2] + ["gap"] * (len(item) // 4) + item[len(item) // 2 :])
        bodies += [item] * clean
    texts = [" ".join([prose(30, i), *body, prose(20, i + 1)]) for i, body in enumerate(bodies)]
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    docs = documents(spark, texts)
    want, known = {}, {}
    for i, text in enumerate(texts):
        for k, item in enumerate(items):
            words = text.split()
            if len(set(words) & set(item)) < 3:
                continue  # too few to reach a half
            key = (k, tuple(bodies[i])) if k < 6 else (k, i)
            if key not in known:
                known[key] = full_alignment(item, words)
            if known[key] >= (0.5 if len(item) >= 8 else 1.0):
                want[i, k] = known[key]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(docs, bench).collect()}
    assert got == pytest.approx(want)
    left = {r.doc_id for r in decontamination.without_contaminated(docs, bench).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in want}


def test_benchmark_blocks_are_dropped_after_their_turn(spark, monkeypatch):
    items = [prose(30, 50 + k) for k in range(6)]
    texts = [f"{prose(9, k)} {item}" for k, item in enumerate(items)] + [items[0], None, "", prose(60, 8), items[0]]
    docs = documents(spark, texts).withColumnRenamed("lang", "digest")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = decontamination.contaminated(docs, bench).collect()
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 50)
    parts = decontamination.contaminated(docs, bench)
    left = decontamination.without_contaminated(docs, bench)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [7, 8, 9]
    for df in (parts, left):  # written tables, with no block's closure in the plan
        assert "MapInArrow" not in df._jdf.queryExecution().toString()


def brute_groups(texts, width, percent):
    sets = []
    for text in texts:
        ws = words_of(lower(text))
        n = min(width, len(ws))
        sets.append({tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)} if ws else set())
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return [(len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("blocks", [None, (4, 64)])
def test_near_duplicates_match_all_pairs(spark, monkeypatch, blocks):
    if blocks:  # many blocks a group
        monkeypatch.setattr(near_duplicates, "BUCKET_BLOCK", blocks[0])
        monkeypatch.setattr(near_duplicates, "SET_BLOCK", blocks[1])
    rng = random.Random(5)
    texts = list(ODD) + ["one", "", None]
    for k in range(8):
        base = prose(rng.choice([6, 30, 120]), 100 + k).split()
        for _ in range(rng.choice([1, 3, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(99)}"
            texts.append(" ".join(copy))
    got = {r.doc_id: r for r in near_duplicates.grouped(documents(spark, texts)).collect()}
    for i, (size, group) in enumerate(brute_groups(texts, 3, 85)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (size, group, group == i)


def test_a_group_of_copies_costs_as_much_as_its_members(spark, monkeypatch):
    """One group of 20,000 signatures near one another, some far from all, some in parts of their own."""
    rng = np.random.default_rng(3)
    n, base = 20_000, rng.integers(0, 1 << 16, 60, dtype=np.uint16)
    rows = np.tile(base, (n, 1))
    rows[np.arange(n), rng.integers(0, 60, n)] = rng.integers(0, 1 << 16, n)
    far = rng.choice(n, 300, replace=False)
    rows[far] = rng.integers(0, 1 << 16, (300, 60))
    rows[far[100:]] = rows[far[100]]  # a second part, in many blocks
    pairs = [(1, int(k), 1, rows[k].tobytes()) for k in range(n)]
    members = spark.createDataFrame(pairs, "grp long, node long, weight long, payload binary").repartition(8)
    members = near_duplicates.in_blocks(members, 1_024)
    moved = []
    plain = near_duplicates.forests

    def counted(units, spread):
        moved.append(units.count())
        return plain(units, spread)

    monkeypatch.setattr(near_duplicates, "forests", counted)
    edges = near_duplicates.connecting(
        members, members.select("grp", "blocks").distinct(), members.select("node", "payload"), 1_024,
        near_duplicates.signature_forest,
    )
    got = {r.node: r.component for r in components(edges).collect()}
    alone, second = set(far[:100].tolist()), set(far[100:].tolist())
    main = set(range(n)) - alone - second
    want = {k: min(main) for k in main} | {k: min(second) for k in second}
    assert got == want
    assert sum(moved) < 3 * n  # all pairs of the 20 blocks would be 20 * n rows


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_mix_meets_its_targets(spark):
    sources = [["hot", "b", None, "c"][min(3, i % 7)] for i in range(400)]
    texts = [None if i % 50 == 0 else prose(1 + i % 90, i) for i in range(400)]
    docs = documents(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    total = sum(r.size for r in rows)
    size, target, taken = Counter(), {}, Counter()
    for r in rows:
        source = sources[r.doc_id]
        assert r.size == len(words_of(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        size[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
        assert r.source_size == sum(len(words_of(t)) for t, s in zip(texts, sources) if s == source)
    for source in target:
        assert target[source] <= 2 * size[source] + 1e-6
        assert abs(taken[source] - target[source]) <= 1
    assert sum(target.values()) == pytest.approx(1.5 * total)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


PRIVATE = [
    "mail ana.b+x@mail.example.org, or @x a@b a@b. a@b.c.", "ip 10.0.0.1 and 1.2.3.4.5.6.7.8 999.1.1.1 256.1.1.1.2",
    "card 4111 1111 1111 1111 4111-1111-1111-1112", "call +49 (30) 123-456.78 or +1 or +123456789012345678",
    "🙂🙂 a@b.co 🙂 10.1.1.1", "x@y..z a@@b.c a@b-.c-d", "7" * 600, "1.1.1.1" * 40, "+" * 50 + "1 2", "a@" * 300,
    "00000000000000000000 000000000000 0.0.0.0", "contact: bob (at) mail (dot) org",
]


def test_private_data_matches_the_base_patterns(spark):
    texts = ODD + PRIVATE * 3
    for r in private_data.detected(documents(spark, texts)).collect():
        base = base_spans(texts[r.doc_id])
        kinds = Counter(s.split(":")[0] for s in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in BASE], texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",") if r.spans else [])


def luhn_ok(value):
    digits = [int(c) for c in value if c.isdigit()]
    doubled = [d * 2 - 9 if d > 4 else d * 2 for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def may_be_added(kind, value):
    n = sum(c in "0123456789" for c in value)
    if kind == "ip":
        numbers = re.findall("[0-9]+", value)
        return len(numbers) == 4 and all(int(x) <= 255 for x in numbers)
    if kind == "card":
        return 12 <= n <= 19 and luhn_ok(value)
    if kind == "phone":
        return 9 <= n <= 15
    plain = re.sub(r"\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?|\s(?:at|AT)\s|\s?@\s?", "@", value)
    plain = re.sub(r"\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:dot|DOT)\s", ".", plain)
    return re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", plain) is not None


def edge(c):
    return 2 if c.isalnum() else 1 if c.strip() else 0


def proposals(text):
    """(features, start, stop) of every proposal that the check allows and no base span overlaps."""
    base = [tuple(map(int, b.split(":")[1:])) for b in base_spans(text)]
    for number, kind in enumerate(BASE):
        matches = list(re.finditer(private_data.GENERATORS[kind], text))
        for k, m in enumerate(matches):
            if not may_be_added(kind, m.group()) or any(a < m.end() and m.start() < z for a, z in base):
                continue
            last = matches[k - 1].end() if k else 0
            upcoming = matches[k + 1].start() if k + 1 < len(matches) else len(text)
            before = text[max(last, m.start() - 24) : m.start()]
            after = text[m.end() : min(m.end() + 1, upcoming)]
            rest = re.sub("[A-Za-z0-9]+", "", m.group())
            features = {
                "kind": number,
                "separators": 0 if not rest else 1 if re.fullmatch("[ -]+", rest) else 2 if re.fullmatch("[@._%+-]+", rest) else 3,
                "before": edge(before[-1:]),
                "after": edge(after),
                "cue": int(re.search(private_data.CUES[kind], before) is not None),
                "marked": 2 if re.search(r"[:=#]\s*$", before) else 1 if re.search(r"""["'(<\[]$""", before) else 0,
            }
            yield features, m.start(), m.end()


def test_added_spans_are_those_the_trees_accept(spark):
    rng = random.Random(8)

    def phone(prefix):
        return prefix + f"{rng.randrange(100, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}"

    texts = []
    for i in range(900):
        word = prose(2, i)
        texts.append(
            rng.choice(
                [
                    f"{word} phone: {phone('+49 ')}, mail to ana{i}@mail.org now",
                    f"{word} call {phone('+1 ')} or write bob{i}@mail.org",
                    f"{word} in {rng.randrange(10, 99)}.{rng.randrange(10, 99)} of {rng.randrange(1000, 2030)}-11-{rng.randrange(10, 28)} {word}",
                    f"{word} user@{word.split()[0]} and version 1.{i}.{rng.randrange(9)} for @{word.split()[1]}",
                    f"{word} host 10.{i % 250}.3.4 took {rng.randrange(100, 999)}.{rng.randrange(10)} s",
                ]
            )
        )
    texts += [f"phone: 030 {k}55 1234 {k}" for k in range(10)] + [f"x 030 {k}55 1234 x" for k in range(10)]
    texts += ["mail ana [at] mail [dot] org", "bob at mail dot org", "mail a (at) b", "host 10 . 1 . 2 . 3 x", "10.1.2.3.4 030 555 1234"]
    texts += ["phone: 030 555 1234 +49 301 555 1234 phone: 040 555 1234", None, ""]
    docs = documents(spark, texts)
    found = docs.select("doc_id", private_data.candidates(docs["text"]).alias("spans"))
    detector = private_data.train(found, private_data.half_of(found["doc_id"]))
    assert any(t <= 1 for t in detector.thresholds)  # a kind with evidence on both sides
    assert detector.thresholds[2] > 1  # no card was seen
    added = refused = 0
    for r in private_data.detected(docs).collect():
        text = texts[r.doc_id] or ""
        want = [(int(s.split(":")[1]), list(BASE).index(s.split(":")[0]), int(s.split(":")[2])) for s in base_spans(text)]
        for features, start, stop in proposals(text):
            if detector.trees.of(features) >= detector.thresholds[features["kind"]]:
                want.append((start, features["kind"], stop))
                added += 1
            else:
                refused += 1
        assert r.spans == ",".join(f"{list(BASE)[k]}:{a}:{z}" for a, k, z in sorted(want)), text
    assert added >= 5 and refused >= 5


def test_trees_see_nothing_of_the_checks():
    assert not {"digits", "luhn", "octets"} & set(private_data.FEATURES)


def test_texts_of_very_many_matches(spark):
    many = " ".join(f"10.{i % 256}.{i // 256}.7" for i in range(20_000))
    mixed = "".join(rng_piece for i in range(3_000) for rng_piece in (f"é🙂 {i} ", f"a{i}@b.co,10.0.0.{i % 256} +49 30 555 {i:04d}x"))
    docs = documents(spark, [many, mixed, "plain " * 50_000])
    rows = {r.doc_id: r for r in private_data.detected(docs).collect()}
    assert rows[0].n_ip == 20_000 and rows[2].spans == ""
    want = base_spans(mixed)
    assert rows[1].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    clean = {r.doc_id: r.text for r in private_data.redacted(docs).collect()}
    assert clean[0] == " ".join(["[IP]"] * 20_000) and clean[2] == "plain " * 50_000
    upto, out = 0, []
    spans = [s.split(":") for s in rows[1].spans.split(",")]
    for kind, start, stop in [(k, int(a), int(z)) for k, a, z in spans]:
        if start >= upto:
            out += [mixed[upto:start], f"[{kind.upper()}]"]
        upto = max(upto, stop)
    assert clean[1] == "".join(out) + mixed[upto:]


def test_running_sums_and_maxima(spark):
    for n in (0, 1, 63, 64, 65, 4_095, 4_097, 9_000):
        values = [(7 * k) % 1000 for k in range(n)]
        row = spark.createDataFrame([(values,)], "v array<int>").select(
            private_data.running(F.col("v"), lambda a, x: a + x, F.lit(0)).alias("sums"),
            private_data.running(F.col("v"), lambda a, x: F.greatest(a, x), F.lit(-1)).alias("most"),
        ).first()
        assert row.sums == [sum(values[:k]) for k in range(n)] if n < 5000 else row.sums[-1] == sum(values[:-1])
        assert row.most == [max(values[:k], default=-1) for k in range(n)]


def test_redaction_takes_the_spans_out(spark):
    docs = documents(spark, ["write to ana@mail.org now", None, "clean", "10.0.0.1"])
    got = private_data.redacted(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {
        0: "write to [EMAIL] now", 1: None, 2: "clean", 3: "[IP]",
    }


def test_toxicity_learns_from_labels_it_may_see(spark):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        body = [prose(8, i * 10 + k) for k in range(rng.randrange(1, 6))]
        if bad:
            body.insert(rng.randrange(len(body) + 1), prose(3, i) + " vile scum " + prose(2, i))
        texts.append(". ".join(body) + ".")
        labels.append((i, 1, int(bad)))
    docs = documents(spark, texts)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, table)
    rows = toxicity.score(docs, model).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == labels[r.doc_id][2] for r in held) >= 0.97 * len(held)
    # labels of held-out rows have no influence
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    again = toxicity.train(docs, spark.createDataFrame(other, "doc_id long, quality int, toxic int"))
    assert again.weights == model.weights
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_repeated_ids_do_not_widen_the_sample(spark, monkeypatch):
    texts = [f"good words {i}. more of them." if i % 2 else f"vile scum {i}. words." for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, f"z{k} again") for k in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    seen = []
    ascend = toxicity._ascend
    monkeypatch.setattr(toxicity, "_ascend", lambda bags, size: seen.extend(bags) or ascend(bags, size))
    model = toxicity.train(docs, labels)
    learnable = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert sorted(r["doc_id"] for r in seen) == sorted(learnable)
    once = toxicity.train(docs.filter("text not like 'z%'"), labels)
    assert (model.bias, model.weights) == (once.bias, once.weights)


def test_scores_are_noisy_or_over_sentences(spark):
    weights = {"vile": 9.0, "scum": 2.0, "kind": -3.0}
    model = toxicity.Model(-4.0, weights)
    texts = ["Vile scum. Fine day.", "vile\n\nkind vile! scum?", "no known word here. None here", "", None, "...", "scum " * 50]
    for r in toxicity.score(documents(spark, texts), model).collect():
        text = texts[r.doc_id] or ""
        doubt = 1.0
        for sentence in toxicity.SENTENCE.findall(text):
            words = set(toxicity.WORD.findall(sentence.lower()))
            if words:
                known = sum(weights.get(f, 0.0) for w in words for f in toxicity.features(w))
                doubt *= 1 - 1 / (1 + math.exp(4.0 - known))
        assert r.score == pytest.approx(1 - doubt, abs=1e-12), text
        assert r.predicted == int(1 - doubt >= 0.7)


@pytest.mark.parametrize("labels", [[], [(0, 1, None), (None, 1, 1), (99, 1, 1)]])
def test_no_text_is_toxic_without_evidence(spark, labels):
    docs = documents(spark, [". ".join(prose(5, k) for k in range(1000)) + ".", "short", None, ""])
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = toxicity.score(docs, model).collect()
    assert {(r.score, r.predicted, r.n_offending) for r in rows} == {(0.0, 0, 0)}
    assert toxicity.without_toxic(docs, model).count() == 4


def test_word_and_line_measures(spark):
    texts = ODD + ["a b c a b c\na b c\na b c", "x # $ %\nx # $ %\n\nx # $ %", prose(200, 3), "go " * 90]
    for r in quality.measures(documents(spark, texts)).collect():
        text = texts[r.doc_id] or ""
        ws = words_of(text)
        windows = Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
        inside = {k + d for k in range(len(ws) - 2) if windows[tuple(ws[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if words_of(x)]
        failed = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(inside), failed,
        ), text
        assert not (failed and r.kept)


def test_license_templates_are_found(spark):
    name, template = next(iter(licenses.TEMPLATES.items()))
    texts = [prose(300, 1) + " " + template + " " + prose(300, 2), prose(400, 5), None, ""]
    rows = licenses.scan(documents(spark, texts)).collect()
    assert {(r.doc_id, r.license) for r in rows} == {(0, name)} and rows[0].containment == 1.0


@pytest.mark.parametrize("name, text", [
    ("BSD-2-Clause-conditions", """1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer.
     2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("ISC-text", """Permission to use, copy, modify, and distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MPL-2.0-notice", """// This Source Code Form is subject to the terms of the Mozilla Public
        // License, v. 2.0. If a copy of the MPL was not distributed with this
        // file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("AGPL-3.0-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the
        License, or (at your option) any later version."""),
    ("Unlicense-text", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("CC-BY-ND-4.0-notice", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
])
def test_common_published_notices_are_found(spark, name, text):
    docs = documents(spark, [prose(90, 1) + " " + text + " " + prose(70, 2), prose(200, 3)])
    rows = licenses.scan(docs).collect()
    assert (0, name) in {(r.doc_id, r.license) for r in rows} and all(r.doc_id == 0 for r in rows)


def test_rules_and_links_judge_pages(spark):
    rows = [
        (1, "https://A.Example.org/es/x", ""), (2, "http://a.org", '<a href="https://good.net/x">'),
        (3, "http://shop.com/de/1?q", '<a href="https://bad.net/y">'), (4, "http://shop.com/fr/", ""),
        (5, "https://bad.net/z", '<a href="https://bad.net/y">'), (6, "https://good.net", ""), (7, None, None), (8, "nohost", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in link_graph.judged(pages).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2][:3] == ("a.org", "", None) or got[2][2] is None
    assert got[3] == ("shop.com", "/de/1", "com/de/", "block")
    assert got[4] == ("shop.com", "/fr/", "com/fr/", "allow")
    assert got[7][:2] == ("", "") and got[8][:2] == ("", "")
    assert all(verdict in ("allow", "block") for *_, verdict in got.values())
    json.dumps(got)


def brute_ranks(seeds, links):
    """Personalised PageRank over (src, dst) links, 10 rounds by dictionaries."""
    seeds = {h: n / sum(seeds.values()) for h, n in seeds.items()}
    rank = dict(seeds)
    out = Counter(src for src, _ in links)
    for _ in range(10):
        new = {h: 0.15 * s for h, s in seeds.items()}
        for src, dst in links:
            new[dst] = new.get(dst, 0) + 0.85 * rank.get(src, 0) / out[src]
        rank = new
    return rank


def test_verdicts_spread_over_a_planted_link_graph(spark):
    rng = random.Random(4)
    free = [f"h{k}.net" for k in range(12)]
    rows = [("bad.com", "/de/1", free[:2]), ("good.com", "/fr/1", free[2:6])] * 4
    rows += [("hot.net", f"/{k}", [rng.choice(free), "bad.com"]) for k in range(60)]  # a hot host
    rows += [(h, "/x", rng.sample(free, 2) + (["bad.com"] if k % 3 == 0 else [])) for k, h in enumerate(free)]
    pages = spark.createDataFrame(
        [(i, f"http://{h}{p}", "".join(f'<a href="//{x}/y">' for x in to)) for i, (h, p, to) in enumerate(rows)],
        "page_id long, url string, html string",
    )
    links = [(h, x) for h, _, to in rows for x in to if x != h]
    trust = brute_ranks({"good.com": 4}, links)
    distrust = brute_ranks({"bad.com": 4}, [(b, a) for a, b in links])
    verdicts = set()
    for r in link_graph.judged(pages).collect():
        good, bad = trust.get(r.host, 0), distrust.get(r.host, 0)
        assert (r.trust, r.distrust) == pytest.approx((good, bad))
        if r.rule is None:
            assert r.verdict == ("block" if bad > good and bad >= 0.05 else "allow")
            verdicts.add(r.verdict)
    assert verdicts == {"allow", "block"}
