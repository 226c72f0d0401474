import random
import re
from collections import Counter

import numpy as np

from playmart.llm import queries, quality as Q
from tests.conftest import tuples
from tests.llm.conftest import AWKWARD


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for k in range(len(words) - 2):
        if grams[tuple(words[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    lines, seen, dups = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dups,
            len(hit)]


def test_counts_equal_brute_force():
    rng = random.Random(6)
    parts = ["a", "b", "cé", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", " ", "#", "<|>", "a b a "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert Q.statistics(text)[0] == brute(text), repr(text)


def test_wide_vocabularies_use_exact_codes():
    words = [str(k).encode() for k in range((1 << 20) + 5)]
    assert Q.repeated_words(words + words[:3] + words[5:8]) == 12


def sample(n, rng):
    x = rng.normal(size=(n, len(Q.FEATURES)))
    return x, (x[:, 0] - 2 * x[:, 2] + 0.3 * rng.normal(size=n) > 0).astype(float)


def test_flat_trees_learn_and_keep_directions():
    rng = np.random.default_rng(1)
    x, y = sample(3000, rng)
    trees = Q.grow(x, y, list(Q.FEATURES.values()))
    held, truth = sample(1000, rng)
    assert ((trees.score(held) > 0) == truth).mean() > 0.9
    for k, direction in enumerate(Q.FEATURES.values()):
        if direction:
            steps = np.repeat(held[:50], 40, axis=0)
            steps[:, k] = np.tile(np.linspace(-4, 4, 40), 50)
            scores = trees.score(steps).reshape(50, 40)
            assert (np.diff(scores, axis=1) * direction >= -1e-9).all()
    assert Q.grow(x, np.ones(len(x)), list(Q.FEATURES.values())) is None


def test_scores_follow_the_nodes():
    rng = np.random.default_rng(2)
    x, y = sample(400, rng)
    t = Q.grow(x, y, list(Q.FEATURES.values()))
    for row, score in zip(x[:20], t.score(x[:20])):
        total = t.base
        for node in t.roots:
            while t.left[node] != node:
                node = t.left[node] if row[t.feature[node]] <= t.threshold[node] else t.right[node]
            total += t.value[node]
        assert abs(total - score) < 1e-9


def corpus(rng):
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(800)]
    rows = []
    for i in range(300):
        words = [str(w) for w in rng.choice(vocabulary, 120)]
        if i % 4 == 0:
            words = [w + " ### %%%" for w in words]
        rows.append((i, " ".join(words)))
    return rows


def test_query_and_stage_on_awkward_rows(spark, docs, tmp_path):
    rows = corpus(np.random.default_rng(3)) + [(i and i + 1000, t) for i, t in AWKWARD]
    labels = [(i, int(i % 4 != 0), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0), (9999, 1, 0)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    got = queries.op7_quality_rules(spark, str(tmp_path)).collect()
    assert sorted([r.doc_id, *r[1:6]] for r in got if r.doc_id is not None) == sorted(
        [i, *brute(t)] for i, t in rows if i is not None)
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    held = {r.doc_id: r.kept for r in got if r.doc_id is not None and 200 <= r.doc_id < 300}
    assert held == {i: i % 4 != 0 for i in range(200, 300)}


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    clash = docs(AWKWARD).withColumnRenamed("lang", "score")
    out = Q.judge(clash, Q.train(clash, none))
    assert out.count() == len(AWKWARD) and out.columns == [*clash.columns, "quality"]
    assert Q.judge(docs([]), None).count() == 0
    assert tuples(Q.judge(docs([(1, " ".join(f"w{k}" for k in range(60)))]), None).select(
        "quality.kept")) == [(True,)]


def test_repeated_ids_do_not_pass_the_sample(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "grow", lambda x, y, directions: seen.append((len(x), y.tolist())))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    df = docs([(1, f"text number {k}") for k in range(300)] + [(2, "other text")])
    for parts in (1, 5):  # the rows that teach do not depend on the partitions
        Q.train(df.repartition(parts), labels, sample=10)
    assert seen[0][0] <= 10 and seen[0] == seen[1]
