"""Every stage on its own input against a brute-force version, and the whole run."""

import hashlib
import re

import corpus_pipeline

from . import test_bpe, test_line_dedup, test_mixing, test_quality, test_simhash
from .data import EDGES, documents, table


def corpus(spark, tmp_path):
    rows = documents(9, 120, (20, 90)) + [r for r in EDGES if r[0] not in (4, None)]
    seen = set()
    rows = [(i + 1000 * (i in seen) or i, *r) for i, *r in rows if not (seen.add(i) if i not in seen else None)]
    rows = list({r[0]: r for r in rows}.values())
    table(spark, rows, ["kept", "size"]).write.parquet(str(tmp_path / "documents.parquet"))
    return spark.read.parquet(str(tmp_path / "documents.parquet"))


def test_stages(spark, tmp_path):
    docs = corpus(spark, tmp_path)
    sf = str(tmp_path)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    plain = lambda df: [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    results = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        results[name] = spark.read.parquet(str(tmp_path / name))
        if name != names[-1]:
            assert results[name].columns == docs.columns
        before = results[name]
    rows = plain(docs)
    # quality rules
    want = [r for r, v in zip(rows, test_quality.brute_verdicts(rows)) if v[1]]
    kept = plain(results["quality_rules"])
    assert sorted(kept) == sorted(want) and 10 < len(kept) < len(rows)
    # line dedup
    lines = plain(results["line_dedup"])
    assert sorted((r[0], r[1]) for r in lines) == sorted((r[0], r[3]) for r in test_line_dedup.brute(kept))
    assert all(r[4] == len(r[1]) for r in lines)
    # near duplicates
    fps = {r[0]: test_simhash.plain_fingerprint(r[1]) for r in lines}
    distinct = sorted(set(fps.values()))
    root = test_simhash.groups(distinct, [(a, b) for a in distinct for b in distinct if a < b and bin(a ^ b).count("1") <= 3])
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    near = plain(results["simhash_near_dedup"])
    assert sorted(near) == sorted(r for r in lines if r[0] in least.values())
    # mixing
    copies = test_mixing.brute(near)
    mixed = plain(results["mixing"])
    assert sorted(map(str, mixed)) == sorted(str(r) for r in near for _ in range(copies[r[0]][3]))
    # tokens
    enc = test_bpe.encoder()
    want = [(i, ",".join(map(str, enc.encode_ordinary(t)))) for i, t, *_ in mixed]
    last = results["byte_bpe"].collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in last) == sorted((i, hashlib.sha256(s.encode()).hexdigest()) for i, s in want)
    # the whole run gives the last stage's rows
    assert sorted(map(str, corpus_pipeline.run(spark, sf).collect())) == sorted(map(str, last))


def test_stages_on_edges(spark):
    for rows in (EDGES, []):
        docs = table(spark, rows, ["kept", "gone", "copies"])
        plain = [r[:2] for r in rows]
        want = {
            "quality_rules": [r[:2] for r, v in zip(rows, test_quality.brute_verdicts(rows)) if v[1]],
            "line_dedup": [(r[0], r[3]) for r in test_line_dedup.brute(rows)],
            # rows without words, and the two rows of one text, are groups of equal fingerprints: the least id stays
            "simhash_near_dedup": [r for r in dict.fromkeys(plain) if r[0] not in (2, 3) and r != (None, None)],
            "byte_bpe": [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in plain],
        }
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            if name == "byte_bpe":
                got = [(r.doc_id, r.decoded_sha256) for r in out.collect()]
            else:
                assert out.columns == docs.columns
                got = [(r.doc_id, r.text) for r in out.collect()]
            if name == "line_dedup":
                got = [(i, t or "") for i, t in got]
            if name == "mixing":
                copies = test_mixing.brute(rows) if rows else {}
                sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in plain}
                assert set(got) <= set(plain) and len(got) <= 3 * len(rows) and bool(got) == bool(rows)
                assert all(got.count(r) <= 3 for r in set(got) if sizes[r[0]] and r[0] != 4 and r[0] is not None)
                assert set(copies) <= {i for i, _ in plain}
            else:
                assert sorted(map(str, got)) == sorted(map(str, want[name])), name
