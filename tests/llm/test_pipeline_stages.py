"""Each stage of the pipeline on planted rows, against a brute-force version over its own input."""

import random
import re

import corpus_pipeline
import duckdb
import pytest
from test_corpus_operators import base_spans, brute_groups, documents, full_alignment, prose

from tallylake.llm import mixing
from tallylake.llm.decontamination import words_of as benchmark_words

ITEMS = [" ".join(f"w{random.Random(k * 100 + i).randrange(3000)}" for i in range(n)) for k, n in enumerate((40, 25, 12))]


def sentences(seed, n):
    return ". ".join(prose(8, seed * 50 + k) for k in range(n)) + "."


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """(folder, texts, toxic ids): clean, toxic, copied, benchmark and personal-data rows, and odd ones."""
    rng = random.Random(9)
    texts, toxic = [], set()
    for i in range(240):
        if i % 4 == 0:
            toxic.add(i)
            texts.append(f"{sentences(i, 2)} {prose(3, i)} vile scum {prose(2, i + 1)}. {sentences(i + 500, rng.randrange(1, 4))}")
        else:
            texts.append(sentences(i, rng.randrange(1, 6)))
    for k in range(6):  # exact and near copies
        base = prose(120, 9_000 + k).split()
        for j in range(4):
            copy = list(base)
            if j > 1:
                copy[rng.randrange(120)] = f"edit{j}"
            texts.append(" ".join(copy))
    for k, item in enumerate(ITEMS):  # whole, edited and half items inside a text
        words = item.split()
        for body in (words, [w if n % 6 else "changed" for n, w in enumerate(words)], words[: len(words) // 3]):
            texts.append(" ".join([prose(20, 7_000 + k), *body, prose(15 + len(body), 7_100 + k)]))
    for k in range(8):
        texts.append(f"{prose(30, 8_000 + k)} write to ana{k}@mail.org, 10.0.0.{k} or +49 30 123456{k}8, {prose(9, 8_100 + k)}")
    texts += [None, "", " \n", "one"]
    folder = str(tmp_path_factory.mktemp("planted"))
    sources = [("hot", "b", None)[min(2, i % 5)] for i in range(len(texts))]
    documents(spark, texts, sources).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    bench = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, toxic


def without_copies(rows):
    groups = brute_groups([r["text"] for r in rows], 5, 80)
    return [r for place, (r, (_, first)) in enumerate(zip(rows, groups)) if place == first]


def without_items(rows):
    def copied(text):
        words = benchmark_words(text)
        wanted = [(benchmark_words(item), 0.5) for item in ITEMS]
        return any(full_alignment(item, words) >= least for item, least in wanted)

    return [r for r in rows if not copied(r["text"])]


def without_spans(rows):
    def clean(text):
        merged = []  # overlapping spans get the first one's mark
        for span in base_spans(text):
            kind, start, end = span.split(":")
            if merged and int(start) < merged[-1][2]:
                merged[-1][2] = max(merged[-1][2], int(end))
            else:
                merged.append([kind, int(start), int(end)])
        for kind, start, end in reversed(merged):
            text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
        return text

    return [r | {"text": clean(r["text"])} for r in rows]


def mixed(rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [[r["doc_id"], r["text"], r["source"]] for r in rows])
    taken = {row[0]: row[4] for row in db.execute(mixing.ORACLE).fetchall()}
    return [r | {"taken": taken[r["doc_id"]]} for r in rows if taken[r["doc_id"]] > 0]


def test_every_stage_matches_brute_force(spark, planted):
    folder, texts, toxic = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"])
    brute = {
        "toxicity": lambda rows: [r for r in rows if r["doc_id"] not in toxic],
        "near_duplicates": without_copies,
        "decontamination": without_items,
        "private_data": without_spans,
        "mixing": mixed,
    }
    changed = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder), f"test-{name}")
        got = sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"])
        want = brute[name](rows)
        assert [r["doc_id"] for r in got] == [r["doc_id"] for r in want], name
        assert got == want, name
        changed[name] = got != rows
        rows = got
    assert all(changed.values())  # no stage was idle
    assert not any(re.search(r"@mail\.org", r["text"] or "") for r in rows)
    # the pipeline as one gives the same rows
    whole = sorted((r.asDict() for r in corpus_pipeline.run(spark, folder).collect()), key=lambda r: r["doc_id"])
    assert whole == rows
