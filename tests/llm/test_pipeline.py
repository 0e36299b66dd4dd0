"""The stages against their operators by brute force, on the small tables and on odd rows."""

import os
import subprocess
import sys

import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from cohortlens.llm import common, feistel_pii, toxic_grammar

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {x.split("_")[0] + "_" for x in names if x.startswith("op")}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    docs = common.documents(spark, SF).limit(150).cache()
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}
    toxic = {r["doc_id"] for r in toxic_grammar.toxicity(docs, common.labels(spark, SF)).where("predicted = 1").collect()}
    left = stages["toxicity"](spark, docs, SF)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == rows.keys() - toxic
    last = {}
    for i in sorted(rows.keys() - toxic):
        last[rows[i]["text"].encode().lower()] = i
    left = stages["exact dedup"](spark, common.materialize(left), SF)
    assert {r["doc_id"] for r in left.collect()} == set(last.values())
    near = stages["near dedup"](spark, common.materialize(left), SF)
    assert near.columns == docs.columns and 0 < near.count() <= len(last)
    hidden = stages["personal data"](spark, common.materialize(near), SF)
    assert hidden.columns == docs.columns
    p = feistel_pii.Permutation(feistel_pii.KEY)
    after = {r["doc_id"]: r for r in hidden.collect()}
    assert all(r["text"] == feistel_pii.pseudonymise(rows[i]["text"], p)[0] and r["n_chars"] == len(r["text"]) for i, r in after.items())
    packed = stages["packing"](spark, common.materialize(hidden), SF)
    assert {r["doc_id"] for r in packed.collect()} == set(after)


def test_odd_rows(spark, make, odd):
    docs = make(odd, clash=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, SF))
    assert docs.columns == make(odd, clash=True).columns
    assert docs.count() > 0
    empty = make([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def near_groups(rows):
    """doc_ids that stay, by comparing the fingerprint of every text with every other."""
    prints = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        hashes = [xxhash.xxh64(b" ".join(words[k : k + 3]), 42).intdigest() for k in range(max(1, len(words) - 2))] if words else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    left, stay = set(prints), set()
    while left:
        stay.add(min(left))
        todo = [min(left)]
        left -= set(todo)
        while todo:
            near = {j for j in left if (prints[j] ^ prints[todo[-1]]).bit_count() <= 2}
            todo.pop()
            todo += near
            left -= near
    return stay


def test_near_copies_of_documents(spark):
    docs = common.documents(spark, "/root/testdata/sf0.01").limit(500).cache()
    left = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, SF)
    assert {r["doc_id"] for r in left.collect()} == near_groups([(r["doc_id"], r["text"]) for r in docs.collect()])


OUTSIDE = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {path!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("op11_conversation_repair", "op12_negative_mining", "op13_token_transducer", "pipeline"):
    print(name, entry.queries()[name](spark, {sf!r}).count() > 0)
"""


def test_workers_need_no_package_on_their_path(tmp_path):
    """A plain session, started elsewhere: the Python workers cannot import the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = OUTSIDE.format(path=os.path.abspath(entry.__file__), sf=SF)
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert run.stdout.count("True") == 4, run.stderr[-2000:]
