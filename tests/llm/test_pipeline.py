"""The pipeline's stages against brute force on a small corpus, each on its own input."""

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm.test_operators import DOCS, components, contaminated, corpus, fingerprint

COLUMNS = list(C.COLUMNS)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Each stage's input and output; the benchmark holds the corpus's passage and one whole document."""
    rows, passage = corpus()
    top = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOCS).select(*COLUMNS).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, rows[2][1])], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{top}/documents.parquet"), []
    for k, (_, stage) in enumerate(C.STAGES):
        stage(spark, docs, str(top)).write.parquet(f"{top}/{k}")
        now = spark.read.parquet(f"{top}/{k}")
        out.append((docs.collect(), now.collect(), now.columns))
        docs = now
    return out, str(top), [(1, passage), (2, rows[2][1])]


def key(r):
    return (str(r["doc_id"]), r["text"] or "")


def test_columns(made):
    assert [sorted(c) for _, _, c in made[0][:-1]] == [sorted(COLUMNS)] * 4


def test_language_stage(made):
    before, after, _ = made[0][0]
    assert sorted(map(key, after)) == sorted(key(r) for r in before if any(map(str.isalpha, r["text"] or "")))


def test_line_stage(made):
    before, after, _ = made[0][1]
    from tidewheel.llm.line_dedup import key_of

    seen = {}
    for i, r in enumerate(before):
        for k in {key_of(x) for x in r["text"].encode().split(b"\n")}:
            seen.setdefault(k, set()).add(i)
    hot = {k for k, own in seen.items() if k and len(own) >= 10}
    want = [(str(r["doc_id"]), b"\n".join(x for x in r["text"].encode().split(b"\n") if key_of(x) not in hot).decode()) for r in before]
    assert sorted(map(key, after)) == sorted(want) and hot
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def one_of_each(before, after):
    """One row of every component stays, of the smallest id if it has one."""
    group = components([fingerprint(r["text"]) for r in before], range(len(before)))
    by_group, groups_of = {}, {}
    for r, c in zip(before, group):
        by_group.setdefault(c, []).append(r)
        groups_of.setdefault(key(r), c)
    assert sorted(groups_of[key(r)] for r in after) == sorted(by_group)
    for r in after:
        assert r["doc_id"] == min((x["doc_id"] for x in by_group[groups_of[key(r)]] if x["doc_id"] is not None), default=None)


def test_near_dedup_stage(made):
    before, after, _ = made[0][2]
    one_of_each(before, after)
    assert len(after) < len(before)


def test_near_dedup_of_shared_and_missing_ids(spark):
    """Id 7 on two texts, one a near copy of 3; near copies without ids; equal rows; null texts."""
    base, other, third = (" ".join(f"{c}{i}" for i in range(200)) for c in "abc")
    near = lambda t: t.replace(t.split()[90], "new", 1)
    rows = [(3, base), (7, near(base)), (7, other), (None, third), (None, near(third)), (None, near(base)), (9, "one"), (9, "one"), (None, None), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    after = C.near_dedup(spark, docs, "").collect()
    one_of_each(docs.collect(), after)
    assert len(after) == 5 and {(r["doc_id"], r["text"]) for r in after if r["doc_id"] is not None} == {(3, base), (7, other), (9, "one"), (4, "")}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_decontamination_stage(made):
    before, after, _ = made[0][3]

    def dirty(r):
        n, hit, _ = contaminated(r["text"], made[2])
        return hit > 0 and 20 * hit >= n

    assert sorted(map(key, after)) == sorted(key(r) for r in before if not dirty(r)) and any(map(dirty, before))


def test_token_stage(made):
    before, after, _ = made[0][4]
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((str(r["doc_id"]), " ".join(map(str, lib.encode(r["text"], add_eos=True))), lib.decode(lib.encode(r["text"]))) for r in before)
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in after) == want


def test_run_is_the_stages(spark, made):
    got = C.run(spark, made[1]).select("doc_id", F.md5("ids").alias("ids"))
    import hashlib

    assert sorted(map(str, got.collect())) == sorted(str(type(got.first())(doc_id=r["doc_id"], ids=hashlib.md5(r["ids"].encode()).hexdigest())) for r in made[0][4][1])
