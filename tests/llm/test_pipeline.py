import os
import subprocess
import sys

from llm.textkit import PROSE, SF_DIR

import corpus_pipeline
from tallyloom.llm import minhash, mixing, pii

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "personal data", "target weights", "tokens"]
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        kept.append(after.count())
        if name != "tokens":
            assert after.columns == columns
            assert dict(after.dtypes) == dict(docs.dtypes)
            before = after
    assert kept[1] < kept[0] and kept[2] < kept[1] and kept[3] == kept[2] and 0 < kept[4] < kept[3] and kept[5] == kept[4]
    found = pii.counts_of(pii.find(before, ["doc_id"]), ["doc_id"])
    assert found.where("n_email + n_ip + n_card + n_phone > 0").count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "ids", "round_trip"} <= set(rows.columns)
    assert rows.count() > 0 and rows.where("not round_trip").count() == 0


def test_near_duplicates_stage_takes_five_words(spark, docs_of):
    words = [f"w{i}" for i in range(200)]
    changed = [w if i not in (50, 100) else "new" for i, w in enumerate(words)]
    docs = docs_of([(1, " ".join(words)), (2, " ".join(changed)), (3, PROSE)])
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, SF_DIR).collect()) == [1, 3]
    assert minhash.Threshold().share == 80 and mixing.DEFAULT.rate <= 1


def test_entry_without_the_subpackage(tmp_path):
    """The other queries import where this subpackage and the pipeline are gone."""
    os.symlink(os.path.join(ROOT, "catalog"), tmp_path / "catalog")
    (tmp_path / "tallyloom").mkdir()
    for part in os.listdir(os.path.join(ROOT, "tallyloom")):
        if part not in ("llm", "__pycache__"):
            os.symlink(os.path.join(ROOT, "tallyloom", part), tmp_path / "tallyloom" / part)
    (tmp_path / "entry.py").write_text(open(os.path.join(ROOT, "__spark_entry__.py")).read())
    code = "import entry; q = entry.queries(); assert 'daily_feed' in q and 'pipeline' not in q; assert set(entry.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
