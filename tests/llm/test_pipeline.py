from __future__ import annotations

import random
import re
from itertools import combinations

from corpus_pipeline import STAGES, jaccard_join, run
from tidemark.llm.common import table


def test_stages(spark, tmp_path):
    assert [name for name, _ in STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    counts = [docs.count()]
    for n, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        assert n == len(STAGES) - 1 or made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    assert run(spark, sf_dir).count() == counts[-1]


def survivors(texts):
    """Brute force: the first of each component of texts that share 0.8 of their five-word shingles."""
    sets, root = [], list(range(len(texts)))
    for text in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        sets.append({tuple(w[n : n + 5]) for n in range(max(1, len(w) - 4))} if w else set())
    for a, b in combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 10 * common >= 8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    return {n for n, r in enumerate(root) if n == r}


def test_near_copies_go_by_five_words_at_four_fifths(spark):
    rng = random.Random(3)
    texts = []
    for size in (1, 4, 5, 6, 9, 12, 20, 40, 41, 60, 90, 150, 400):
        base = [f"w{rng.randrange(300)}" for _ in range(size)]
        texts += [" ".join(base), " ".join(base[: size - 1]), " ".join(base + ["more"])]
        for share in (0.01, 0.02, 0.03, 0.04, 0.05):
            own = [w if rng.random() > share else f"x{rng.randrange(9)}" for w in base]
            texts += [" ".join(own), " ".join(own[: int(size * 0.9)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id for r in jaccard_join(spark, docs, "").collect()} == survivors(texts)


def test_near_copies_of_the_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").dropDuplicates(["doc_id"]).orderBy("doc_id")
    ids, texts = zip(*((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()))
    assert {r.doc_id for r in jaccard_join(spark, docs, "").collect()} == {ids[n] for n in survivors(texts)}


CLASHING = "labelled own own_key text_key row rows stay key doc id node size mark score kept taken piece ids bin open".split()


def test_stages_take_nulls_repeats_and_clashing_columns(spark, tmp_path):
    """Every stage on rows with nulls anywhere, empty and very long texts, repeated rows, and columns named as
    those that the stages make; then on no rows at all."""
    rng = random.Random(1)
    text = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    texts = [text(rng.choice([1, 4, 30, 120])) for _ in range(60)] + [text(30_000), None, "", " \t", "x" * 50_000]
    rows = [(n, t, "en" if n % 3 else None, "s" if n % 4 else None, None if n % 5 else n) for n, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], None, None, None), (None, None, None, None, None), (None, texts[2] + " more", "en", "s", 1)]
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in CLASHING)
    whole = spark.createDataFrame([(*r, *CLASHING) for r in rows], schema)
    (tmp_path / "labels.parquet").mkdir()
    labels = spark.createDataFrame([(n, n % 2, None if n % 7 == 0 else int(n % 10 == 0)) for n in range(60)], "doc_id long, quality int, toxic int")
    labels.write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    for label, docs in (("whole", whole), ("none", whole.limit(0))):
        counts = []
        for n, (_, stage) in enumerate(STAGES):
            made = stage(spark, docs, str(tmp_path))
            assert n == len(STAGES) - 1 or made.columns == names
            made.write.parquet(f"{tmp_path}/{label}-{n}")
            docs = spark.read.parquet(f"{tmp_path}/{label}-{n}")
            counts.append(docs.count())
        assert counts[0] >= counts[1] >= counts[2] and (counts[-1] > 0) == (label == "whole")
    pieces = spark.read.parquet(f"{tmp_path}/whole-4").collect()
    assert all(len(r.ids) == 4 * r.length and 0 < r.length <= 1024 for r in pieces)
    assert spark.read.parquet(f"{tmp_path}/whole-2").where("doc_id IS NULL").count() >= 1


def test_open_tiles_are_written_once_and_without_bitmaps(spark, monkeypatch):
    """Steps that nothing reads any more go, and no texts are shuffled to drop a few rows."""
    from pathlib import Path

    from tidemark.llm import jaccard
    from tidemark.session import shared_dir

    steps, folder = [], Path(shared_dir(spark))
    before = set(folder.iterdir())

    def stored(df, label, *path):
        made = write(df, label, *path)
        steps.append((label, set(made.columns)))
        assert len([p for p in set(folder.iterdir()) - before if p.name.startswith("open-")]) <= 2
        return made

    write = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", stored)
    rng = random.Random(5)
    texts = []
    for n in range(80):
        own = [f"w{k}" for k in range(90)]
        for at in rng.sample(range(90), 1 + n % 4):
            own[at] = f"x{rng.randrange(6)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = jaccard_join(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == survivors(texts)
    assert "open" in dict(steps) and all("bits" not in columns for label, columns in steps if label == "open")
    left = {p.name.split("-")[0] for p in set(folder.iterdir()) - before}
    assert not left & {"keyed", "tiles", "in_tiles", "open"}
    assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
