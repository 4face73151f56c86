"""The pipeline's stages, each on its own input, against brute force and on odd tables."""

import collections
import hashlib
import sys
from pathlib import Path

import public_tokenizers
import pytest

from ledgerloom.llm import mixing, quality, queries

sys.path.insert(0, str(Path(__file__).parent))
from test_near_copies import brute  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "kept string, size long, u double, fp long, root long, own_key long, own_hash long, set_id long, component_id long, _hash long, copy int, ids string, spans string, clean_text string, whole int, mix_source string"


def digests(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = {}
    for t in set(texts):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        out[t] = len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(library.decode(ids).encode())
    return out


def test_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        seen.append(docs)
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    kept = {r.doc_id: r.clean_text for r in quality.quality(seen[0].select("doc_id", "text")).filter("kept").collect()}
    assert {r.doc_id: r.text for r in seen[1].collect()} == kept
    rows = [(r.doc_id, r.text) for r in seen[1].collect()]
    assert sorted(r.doc_id for r in seen[2].collect()) == sorted(min(rows[i][0] for i in g) for g in brute(rows).values())
    copies = {r.doc_id: r.copies for r in mixing.mix(seen[2]).collect() if r.copies}
    assert collections.Counter(r.doc_id for r in seen[3].collect()) == copies
    texts = [(r.doc_id, r.text) for r in seen[3].collect()]
    own = digests(t for _, t in texts)
    got = docs.collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == collections.Counter((i, *own[t]) for i, t in texts)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, got))


def table(spark, rows, clashing):
    extra = [f.split() for f in CLASHING.split(", ")] if clashing else []
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *[f"cast({7 if kind != 'string' else repr('x')} as {kind}) as {name}" for name, kind in extra])


def prose(k, words=90):
    return "\n".join(" ".join(f"w{(k * 7919 + i * 31) % 100_003}" for i in range(at, at + 15)) + " end." for at in range(0, words, 15))


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("what", ["empty", "odd"])
def test_stages_on_odd_tables(spark, tmp_path, what, clashing):
    import corpus_pipeline

    rows = []
    if what == "odd":
        rows = [(i, prose(i), "en", "a" if i % 3 else None, 100) for i in range(12)]
        rows += [rows[0]] * 3 + [(0, prose(50), None, "b", None), (0, prose(51), "en", "b", 1), (None, prose(52), "en", None, 2), (None, prose(52), "en", None, 2), (None, None, None, None, None)]
        rows += [(20, "", "en", "a", 0), (21, None, "en", "a", 0), (22, prose(60, 60_000), "de", "a", 9), (23, prose(1).replace("w", "W"), "en", "c", 5)]
    docs = table(spark, rows, clashing)
    columns, seen = docs.columns, [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], "").write.parquet(str(tmp_path / name))
        seen.append(spark.read.schema(docs.schema).parquet(str(tmp_path / name)) if k < 3 else spark.read.parquet(str(tmp_path / name)))
        if k < 3:
            assert spark.read.parquet(str(tmp_path / name)).columns == columns
    if what == "empty":
        assert [df.count() for df in seen] == [0] * 5
        return
    good = collections.Counter((r[0], r[1]) for r in rows if r[1])
    assert collections.Counter((r.doc_id, r.text) for r in seen[1].collect()) == good
    # repeated rows and near copies leave one; two texts that share a key are two documents
    left = set(good) - {(23, prose(1).replace("w", "W"))}
    assert collections.Counter((r.doc_id, r.text) for r in seen[2].collect()) == collections.Counter(left)
    mixed = seen[3].collect()
    assert {(r.doc_id, r.text) for r in mixed} <= left and max(collections.Counter((r.doc_id, r.text) for r in mixed).values()) <= 3
    own = digests(r.text for r in mixed)
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in seen[4].collect()) == collections.Counter((r.doc_id, *own[r.text]) for r in mixed)
