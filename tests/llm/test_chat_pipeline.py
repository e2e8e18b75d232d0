"""Reply trees against path enumeration, template round trips, and the pipeline."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentimill.llm import chat, dedup
from sentimill.llm.components import components

NODE = "tree string, node long, parent long, role string, text string, score double"


def brute_paths(rows):
    """(tree, leaf) -> (score, path from the root) of every branch."""
    by = {(t, n): (p, s) for t, n, p, _, _, s in rows}
    parents = {(t, p) for t, _, p, *_ in rows}
    out = {}
    for t, n in by:
        if (t, n) in parents:
            continue
        path, at = [], n
        while at is not None and (t, at) in by and at not in path:
            path.append(at)
            at = by[t, at][0]
        if at in path:
            continue  # a cycle
        out[t, n] = (sum(by[t, x][1] for x in path), path[::-1])
    return out


@pytest.fixture(scope="module")
def trees():
    rng = np.random.RandomState(2)
    rows = []
    for t in range(12):
        for n in range(rng.randint(1, 40)):
            parent = None if n == 0 or rng.rand() < 0.03 else int(rng.randint(max(0, n - 3), n))
            rows.append((f"t{t}", n, parent, ("user", "assistant")[n % 2], f"m{t}.{n} <|im_end|> <\\|x", float(rng.randint(0, 4))))
    rows += [("chain", n, n - 1 if n else None, "user", None, 1.0) for n in range(70)]
    rows += [("lost", 5, 99, "assistant", "its parent is missing", 0.0), ("loop", 1, 2, "user", "x", 1.0), ("loop", 2, 1, "user", "y", 1.0)]
    return rows


@pytest.mark.parametrize("branches", [1, 2, None])
def test_paths_by_enumeration(spark, trees, branches):
    got = defaultdict(dict)
    for r in chat.branch_paths(spark.createDataFrame(trees, NODE), branches).collect():
        assert r.depth not in got[r.tree, r.leaf]
        got[r.tree, r.leaf][r.depth] = r.node
    want = {}
    ranked = defaultdict(list)
    for (t, leaf), (score, path) in brute_paths(trees).items():
        ranked[t].append((-score, -len(path), leaf, path))
    for t, found in ranked.items():
        for _, _, leaf, path in sorted(found)[:branches]:
            want[t, leaf] = dict(enumerate(path))
    assert dict(got) == want and len(want["chain", 69]) == 70


def test_round_trip(spark, trees):
    rows = {(t, n): (role or "", text or "") for t, n, _, role, text, _ in trees}
    back = chat.read_back(chat.format_trees(spark.createDataFrame(trees, NODE), None)).collect()
    paths = brute_paths(trees)
    assert len(back) == len(paths)
    for r in back:
        said = [rows[r.tree, n] for n in paths[r.tree, r.leaf][1]]
        assert [(t.role, t.text) for t in r.turns] == said and r.n_turns == len(said)
        assert r.loss_text == "".join(x for role, x in said if role == "assistant")


def test_hostile_texts(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|im_end|>", "<", "|im_end|>\n", "", None, "\n\n", "<<|", "é<|im_end|>\n漢" * 500,
             "<|im_end|>\n<|im_start|>user\nx", "a" * 200_000]
    rows = [(c, t, role, text) for c, text in enumerate(texts)
            for t, role in enumerate(["user", "assistant", None, "as%0A\nsist<|im_end|>ant"])]
    rows += [(0, 1, "assistant", "a tie"), (None, None, "assistant", "no id"), (None, 3, "user", "second")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("clash"))
    back = {r.tree: r for r in chat.read_back(chat.format_trees(chat.turns_as_tree(df))).collect()}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups["" if c is None else str(c)].append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    assert set(back) == set(groups)
    for k, v in groups.items():
        want = [(x[3], x[5]) for x in sorted(v)]
        assert [(t.role, t.text) for t in back[k].turns] == want
        assert back[k].loss_text == "".join(x for role, x in want if role == "assistant")
        assert back[k].turns_text == "".join(f"{a}\n{b}\n" for a, b in want)
        assert hashlib.sha256(back[k].formatted.encode()).hexdigest() and back[k].formatted.count("<|im_start|>") == len(want)
    assert chat.format_trees(chat.turns_as_tree(df.limit(0))).count() == 0


def test_components(spark):
    rng = np.random.RandomState(6)
    links = [(int(a), int(b)) for a, b in rng.randint(0, 400, (260, 2))] + [(1_000 + i, 1_001 + i) for i in range(100)]
    links += [(5_000, 5_000 + i) for i in range(50)] + [(7, 7), (None, 3)]
    label = {x: x for p in links if None not in p for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {x for x in label if not any(x in p and p[0] != p[1] for p in links)}
    assert got == {k: v for k, v in label.items() if k not in alone}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen " \
           "eighteen nineteen twenty twentyone twentytwo twentythree twentyfour twentyfive twentysix twentyseven twentyeight"
    rows = [(i, f"text number {i} about thing {i * 7} and other matter {i * 13}", "en", "s0") for i in range(40)]
    rows += [(100, base, "en", "s1"), (101, base.replace(" ", "  "), "en", "s1"), (102, base + " added", "en", "s1"),
             (103, "12345 !!!", "en", "s1"), (104, None, "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    path = tmp_path / "documents.parquet"
    docs.write.parquet(str(path))
    stage, kept = docs, []
    for name, f in cp.STAGES:
        stage = f(spark, stage, str(tmp_path))
        if name != "packing":
            assert stage.columns == docs.columns
        kept.append({r.doc_id for r in stage.select("doc_id").collect()})
    assert kept[0] == set(range(40)) | {100, 101, 102}
    assert kept[1] == set(range(40)) | {100, 102} and kept[2] == set(range(40)) | {100}
    assert kept[4] == kept[3] <= kept[2]
    assert {r.doc_id for r in cp.run(spark, str(tmp_path)).collect()} == kept[4]
    assert dedup.keep_first(docs.limit(0)).count() == 0


def test_pipeline_stages_on_messy_rows(spark, messy, empty):
    """Null and repeated ids, null texts, empty tables and clashing names, stage by stage."""
    import corpus_pipeline as cp
    from pyspark.sql import functions as F

    clash = messy.withColumn("mix_rate", F.lit("mine")).withColumn("a.b", F.lit(1)).withColumn("bucket", F.lit("own"))
    for name, stage in cp.STAGES:
        out = stage(spark, clash, "")
        none = stage(spark, clash.limit(0), "")
        assert none.count() == 0
        if name == "packing":
            assert out.count() == clash.count()
            continue
        assert out.columns == clash.columns == none.columns
        rows = {tuple(r) for r in clash.collect()}
        assert {tuple(r) for r in out.collect()} <= rows
    kept = cp.mixing_stage(spark, clash.withColumn("source", F.lit("one")), "")
    assert kept.where("mix_rate <> 'mine'").count() == 0
