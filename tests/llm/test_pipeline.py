"""The pipeline's stages against what brute force keeps, on the smallest tables."""

import re

import corpus_pipeline
from assayer.llm import quality

from .test_decontaminate import brute as benchmark_hits
from .test_packing import own_ids
from .test_quality import brute as counts
from .test_secret_scan import brute as secrets
from .test_simhash import fingerprint, roots


def test_stages(spark, sf_dir):
    tables = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")]
    docs, columns = tables[0], tables[0].columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in tables[1].collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    good = stages["quality rules"](spark, docs, sf_dir)
    failed = {
        i for i, r in rows.items() if (n := counts(r["text"]))[0] < 20 or 100 * n[4] > 30 * n[0]
    }
    judged = {r["id"] for r in quality.judge(docs).where("kept").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == columns and kept == judged and kept < set(rows) - failed

    single = stages["near dedup"](spark, good, sf_dir)
    ids = sorted(kept)
    root = roots([fingerprint(rows[i]["text"]) for i in ids])
    kept = {ids[r] for r in root}
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == kept
    assert len(kept) < len(ids)

    clean = stages["benchmark decontamination"](spark, single, sf_dir)
    hits = benchmark_hits([(i, rows[i]["text"]) for i in kept], items)
    kept -= {int(i) for i, _, n, _ in hits if n}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == kept

    masked = stages["secret scan"](spark, clean, sf_dir)
    assert masked.columns == columns
    texts = {}
    for r in masked.collect():
        text, want, end = rows[r["doc_id"]]["text"], "", 0
        for _, a, b in secrets(text):
            if a >= end:
                want += text[end:a] + "[SECRET]"
            end = max(end, b)
        texts[r["doc_id"]] = want + text[end:]
        assert r["text"] == texts[r["doc_id"]] and r["n_chars"] == len(r["text"])
    assert set(texts) == kept

    packed = corpus_pipeline.run(spark, sf_dir).collect()
    encode = own_ids()
    assert sum(p["length"] for p in packed) == sum(len(encode(t)) + 1 for t in texts.values())
    assert {p["doc_id"] for p in packed} == kept
    assert all(re.fullmatch(r"\d+", str(p["sequence_id"])) for p in packed)
