"""The corpus operators against brute force, and their defined results in edge cases."""

import hashlib
import random
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewheel.llm import decontamination, line_dedup, oracles, pii, queries, suffix_dedup, topk, warc
from tidewheel.llm.common import new_path
from tidewheel.llm.language_id import fit, identify
from tidewheel.llm.sentencepiece_bpe import Codec, encode_decode
from tidewheel.llm.simhash import near_copies, roots
from tidewheel.llm.token_counts import token_counts

SF = "/root/testdata/sf0.001"
PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tw_hits string, tw_near string, id string, word string"


def corpus(seed=3):
    """Nulls, empty and long texts, equal rows, copies near and exact, common lines, benchmark passages, odd characters."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, base = say(60), say(200)
    texts = [say(r.randint(1, 120)) for _ in range(40)]
    texts += [base] * 5 + [base.replace(base.split()[k], "changed", 1) for k in (3, 50, 150)] + [base.upper()]
    texts += [f"{say(20)}\n Common LINE \n{passage}\n{say(10)}" for _ in range(12)] + ["common line"] * 3
    texts += [None, None, "", "", "   \n\t\n", "a", "ß é x \x00 😀 <|endoftext|> </s>", "x" * 5000, say(3000), "ab" * 700]
    rows = [(i, t, "en", "s", 0, "h", "n", "i", "w") for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[45], (None, base, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)], passage


@pytest.fixture(scope="module")
def docs(spark):
    rows, _ = corpus()
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_row(df, *columns):
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


# --- 1: pseudonyms ----------------------------------------------------------------------------------


def feistel(a, b, m, n, tweak, key):
    f = lambda k, x: int(hashlib.sha256(f"{key}|{tweak}|{k}|{x}".encode()).hexdigest()[:15], 16)
    for k in range(pii.ROUNDS):
        a, b = ((a + f(k, b)) % m, b) if k % 2 == 0 else (a, (b + f(k, a)) % n)
    return a, b


def digits(s, kind, key):
    u = len(s) // 2
    a, b = feistel(int(s[:u] or 0), int(s[u:] or 0), 10**u, 10 ** (len(s) - u), f"{kind}{len(s)}", key)
    return (f"{a:0{u}d}" if u else "") + (f"{b:0{len(s) - u}d}" if len(s) > u else "")


def luhn(s):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def named(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r["tw_text"], r["tw_values"]) for r in pii.pseudonymise(df, key).orderBy("doc_id").collect()]


def test_pseudonyms_against_python(spark):
    r = random.Random(1)
    cards = []
    while len(cards) < 20:
        c = "4" + "".join(r.choice("0123456789") for _ in range(15))
        if luhn(c):
            cards.append(c)
    for c, (text, n) in zip(cards, named(spark, [f"pay {c}, thanks" for c in cards])):
        new = text[4:20]
        assert n == 1 and new[:-1] == "4" + digits(c[1:-1], "card", "k") and luhn(new) and text == f"pay {new}, thanks"
    got = named(spark, ["+1 (319) 555-5132", "27.109.211.155", "078-05-1120"])
    new = "1" + digits("3195555132", "phone", "k")
    assert got[0][0] == f"+{new[0]} ({new[1:4]}) {new[4:7]}-{new[7:]}"
    a, b = feistel(27 * 256 + 109, 211 * 256 + 155, 65536, 65536, "ipv4", "k")
    assert got[1][0] == f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"
    a, b = feistel(77, 4 * 9999 + 1119, 898, 99 * 9999, "ssn", "k")
    assert got[2][0] == f"{a + 1 if a < 665 else a + 2:03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def test_pseudonyms_link_and_leave_the_rest(spark):
    got = named(spark, ["4111 1111 1111 1111 and 4111-1111-1111-1111", "4111111111111112", "1999-12-31 31.12.1999 31/12/1999 1999-13-01 30.02.2000", "GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32", None, "", "v1.2.3, 12 apples, 999.1.1.1"])
    a, b = got[0][0].split(" and ")
    assert a.replace(" ", "") == b.replace("-", "") != "4111111111111111" and luhn(a.replace(" ", ""))
    assert got[1] == ("4111111111111112", 0)
    iso, dot, slash, *rest = got[2][0].split(" ")
    assert iso == "-".join(reversed(dot.split("."))) == "-".join(reversed(slash.split("/"))) and iso != "1999-12-31" and rest == ["1999-13-01", "30.02.2000"]
    plain = got[3][0].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1 and plain[4:8] == "WEST" and plain != "GB82WEST12345698765432"
    assert got[4:] == [("GB83 WEST 1234 5698 7654 32", 0), (None, 0), ("", 0), ("v1.2.3, 12 apples, 999.1.1.1", 0)]
    assert named(spark, ["1999-12-31"], "other") != named(spark, ["1999-12-31"])


def test_values_among_further_digits_and_capitals(spark):
    card, iban, phone = "4111 1111 1111 1111", "AT61 1904 3002 3457 3201", "+44 20 7946 0958"
    alone = dict(zip(("7536784127813050", "4845168114407329"), (t for t, _ in named(spark, ["7536784127813050", "4845168114407329"]))))
    alone |= dict(zip((card, "4111111111111111", iban, phone, "+1 415 555 2671", "2024-05-01", "078-05-1120"), (t for t, _ in named(spark, [card, "4111111111111111", iban, phone, "+1 415 555 2671", "2024-05-01", "078-05-1120"]))))
    assert all(old != new for old, new in alone.items())
    cases = [f"{card} 12/27", "4111111111111111 123", f"{iban} BIC", f"{phone} 2024-05-01", "+1 415 555 2671 2024", f"7 {card}", f"{card} {card} 99", f"{card} 078-05-1120", f"{iban} {iban}", f"x {phone}, {card}", "7536784127813050 4845168114407329"]
    for case, (text, n) in zip(cases, named(spark, cases)):
        want = case
        for old in ("7536784127813050", "4845168114407329", card, "4111111111111111", iban, "+1 415 555 2671", phone, "2024-05-01", "078-05-1120"):
            want = want.replace(old, f"<{old}>")
        want, k = re.sub("<([^>]*)>", lambda m: alone[m[1]], want), want.count("<")
        assert (text, n) == (want, k), case


def test_dates_are_permuted(spark):
    days = spark.range(20_000).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("text"), F.col("id").alias("doc_id"))
    out = pii.pseudonymise(days, "k")
    assert out.select("tw_text").distinct().count() == 20_000 and out.where("try_cast(tw_text as date) is null").count() == 0


# --- 2: decontamination -----------------------------------------------------------------------------


def words(text):
    return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower())


def contaminated(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(13, len(iw))
        if not n:
            continue
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
        at = [i for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in wins]
        if at:
            found.add(str(item))
            hit.update(p for i in at for p in range(i, i + n))
    return len(w), len(hit), sorted(found)


def test_contamination(spark, docs):
    rows, passage = corpus()
    parts = passage.split()
    items = [(10, passage), (9, " ".join(parts[5:18])), (8, " ".join(parts[20:24])), (7, parts[3]), (6, None), (5, "..."), (4, "not in any document at all"), (9, "x" * 5000), (3, " ".join(parts[:12]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = decontamination.contamination(docs, bench, keep=("tw_near", "id"))
    assert by_row(got, "doc_id", "tw_words", "tw_hit", "tw_items") == sorted((str(r[0]), *map(str, contaminated(r[1], items))) for r in rows)
    assert got.columns == ["doc_id", "text", "tw_near", "id", "tw_words", "tw_hit", "tw_items"] and {tuple(r) for r in got.select("tw_near", "id").collect()} == {("n", "i"), (None, None)}
    with pytest.raises(ValueError, match="tw_hit"):
        decontamination.contamination(docs.withColumn("tw_hit", F.lit(1)), bench, keep=("tw_hit",))


def test_contamination_by_texts_under_one_id(spark, tmp_path):
    """Two occurring texts of one id, and one without an id, against brute force and the SQL."""
    words_ = [f"w{i}" for i in range(60)]
    one, two, three = " ".join(words_[:15]), " ".join(words_[20:34]), " ".join(words_[40:55])
    bench = spark.createDataFrame([(7, one), (7, two), (None, three), (None, one), (8, None)], "item_id long, text string")
    texts = [f"{one} x {two}", f"y {two}", f"z {three}", f"{one} {three}", "none of them", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["tw_hit"], r["tw_items"]) for r in decontamination.contamination(docs, bench).collect())
    assert got == [(0, 29, ["7", None]), (1, 14, ["7"]), (2, 15, [None]), (3, 30, ["7", None]), (4, 0, []), (5, 0, [])]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    df = queries.op2_decontamination(spark, str(tmp_path))
    sql = duck.execute(oracles.ORACLES["op2_decontamination"])
    columns = [c[0] for c in sql.description]
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, sql.fetchall()))


def test_winnowing_guarantee():
    r = np.random.default_rng(0)
    for length in range(1, 14):
        shared = r.integers(0, 1 << 63, length).astype(np.uint64)
        for _ in range(20):
            a, b = (np.concatenate([r.integers(0, 1 << 63, r.integers(0, 9)).astype(np.uint64), shared, r.integers(0, 1 << 63, r.integers(0, 9)).astype(np.uint64)]) for _ in range(2))
            kept = [set(decontamination.winnow(x, np.array([0, len(x)]), length)[1].tolist()) for x in (a, b)]
            assert kept[0] & kept[1]


def test_contamination_without_broadcast(spark, docs, monkeypatch):
    rows, passage = corpus()
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    result = lambda: by_row(decontamination.contamination(docs, bench), "doc_id", "tw_hit", "tw_items")
    want = result()
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert result() == want
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    assert result() == want


# --- 3: lines ---------------------------------------------------------------------------------------


def test_line_dedup(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 40)  # several shards
    rows, _ = corpus()
    seen = {}
    for i, r in enumerate(rows):
        for k in {line_dedup.key_of(x) for x in (r[1] or "").encode().split(b"\n")}:
            seen.setdefault(k, set()).add(i)
    hot = {k for k, own in seen.items() if k and len(own) >= 10}
    assert hot == {b"common line"} | {k for k in hot if k != b"common line"} and b"common line" in hot
    want = []
    for r in rows:
        lines = (r[1] or "").encode().split(b"\n")
        kept = [x for x in lines if line_dedup.key_of(x) not in hot]
        want.append((str(r[0]), b"\n".join(kept).decode(), str(len(lines)), str(len(lines) - len(kept))))
    got = line_dedup.dedup_lines(docs, keep=("lang", "tw_hits", "id"))
    assert by_row(got, "doc_id", "text", "tw_lines", "tw_dropped") == sorted(want)
    assert got.columns == ["doc_id", "text", "lang", "tw_hits", "id", "tw_lines", "tw_dropped"] and {tuple(r) for r in got.select("tw_hits", "id").collect()} == {("h", "i"), (None, None)}
    with pytest.raises(ValueError, match="tw_lines"):
        line_dedup.dedup_lines(docs.withColumn("tw_lines", F.lit(1)), keep=("tw_lines",))


def test_crowded_shards_and_null_ids(spark, monkeypatch):
    """Documents without an id, and a line so common that its shard is copied to several tasks."""
    monkeypatch.setattr(line_dedup, "PROBES", 20)
    texts = [f"everywhere\nonly in {i}" for i in range(90)] + ["only in 5\nx"] * 9 + [None, ""]
    docs = spark.createDataFrame([(None if i % 3 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = sorted((r["text"], r["tw_dropped"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == sorted([(f"only in {i}", 1) for i in range(90) if i != 5] + [("", 2)] + [("x", 1)] * 9 + [("", 0)] * 2)


def test_shard_counts_all_keys():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        h1, h2 = r.integers(-(1 << 63), 1 << 63, n), r.integers(-(1 << 63), 1 << 63, n)
        counts = r.integers(1, 1 << 34, n)
        shard = line_dedup.Shard(line_dedup.build_shard(h1, h2, counts))
        assert (shard.count(h1, h2) == np.minimum(counts, line_dedup.FULL)).all()
        other = r.integers(-(1 << 63), 1 << 63, 1000)
        assert (shard.count(other, other[::-1].copy()) > 0).sum() <= 1


# --- 4: top-k ---------------------------------------------------------------------------------------


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", 64)
    r = np.random.default_rng(2)
    centres = r.normal(size=(6, 8))
    data = [(int(i), [float(x) for x in centres[i % 6] + r.normal(size=8) * 0.2]) for i in range(500)]
    data += [(1000 + i, data[3][1]) for i in range(30)]  # ties
    odd = [(2000, None), (2001, [1.0, None]), (2002, [float("nan")]), (2003, [float("inf")]), (None, [1.0] * 8), (2004, []), (2005, [5.0]), (3, data[3][1])]
    odd += [(100, [-x for x in data[7][1]]), (150, data[150][1]), (3, [9.0] * 8)]  # queries and candidates of shared ids
    df = spark.createDataFrame([*data, *odd], "vec_id long, embedding array<float>").repartition(4)
    ints = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in [*data, *odd[-4:]]]
    ints += [(2004, np.zeros(8, np.int64)), (2005, np.array([1280] + [0] * 7))]
    want = []
    for at, (q, own) in enumerate(ints):
        if q % 50 == 0:
            best = sorted((-int(own @ v), i) for k, (i, v) in enumerate(ints) if k != at)[:5]
            want += [(str(q), str(k + 1), str(i), str(-s)) for k, (s, i) in enumerate(best)]
    got = topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert by_row(got, "query_id", "rank", "vec_id", "score") == sorted(want)
    shared = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0, 0.0])], "vec_id long, embedding array<float>")
    assert by_row(topk.top_k(shared, F.col("vec_id") == 0), "rank", "vec_id", "score") == [("1", "1", "196608"), ("2", "1", "65536")]
    huge = spark.createDataFrame([(0, [1e17, 1e17]), (1, [1e17, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="2\\*\\*62"):
        topk.top_k(huge, F.col("vec_id") == 0)
    few = spark.createDataFrame(data[:3], "vec_id long, embedding array<float>")
    assert topk.top_k(few, F.col("vec_id") == 0).count() == 2
    assert topk.top_k(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_large_components_stay_exact():
    ids = np.arange(40)
    rows = np.random.default_rng(3).integers(-(1 << 30), 1 << 30, (40, 2))
    which, vec, score = topk.Group(ids, rows).search(rows[:1], np.array([topk.NONE]), 3, np.array([0]))
    assert score[0] == max(int(rows[0] @ x) for x in rows[1:]) and len(which) == 3 and vec[0] != 0


# --- 5 and 9: tokens --------------------------------------------------------------------------------


def test_sentencepiece(docs):
    lib, rows = sentencepiece.SentencePieceProcessor(model_file=PIECES), corpus()[0]
    want = []
    for r in rows:
        ids = lib.encode(r[1] or "", add_eos=True)
        want.append((str(r[0]), str(len(ids)), " ".join(map(str, ids)), lib.decode(ids)))
    assert by_row(encode_decode(docs, PIECES), "doc_id", "tw_n", "tw_ids", "tw_text") == sorted(want)


def test_codec_on_random_text():
    lib, own, r = sentencepiece.SentencePieceProcessor(model_file=PIECES), Codec(PIECES), random.Random(4)
    parts = ["a", "the", " ", "  ", "    ", "ing", "\n", "\t", "é", "日本", "😀", "\x00", "<s>", "<0x0A>", "▁", "́", "12", ".", "Der", " ", "�", "tion", "x" * 60]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 15))) for _ in range(4000)]
    for text, (found, decoded) in zip(texts, own.encoded(texts), strict=True):
        ids = list(map(int, found.split()))
        assert ids == lib.encode(text) and own.decoded(ids)[1:] == decoded == lib.decode(ids)


MEASURED = """
import resource, sys
sys.path.insert(0, sys.argv[1])
{body}
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
{call}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def megabytes(body, call):
    """What a call adds to the peak memory of a new process."""
    out = subprocess.run([sys.executable, "-c", MEASURED.format(body=body, call=call), str(Path(__file__).parents[2])], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr
    return int(out.stdout)


def test_sentencepiece_memory_without_spaces():
    """16 MiB without a word mark: a few bytes a character, not a tuple a match."""
    body = f"from tidewheel.llm.sentencepiece_bpe import Codec\nown = Codec({PIECES!r})\ntext = 'abcdefgh' * (2 << 20)"
    assert megabytes(body, "ids, decoded = next(own.encoded([text])); assert decoded == text") < 600


def test_token_counts(docs):
    lib, rows = Tokenizer.from_file(BYTES), corpus()[0]
    want = [(str(r[0]), str(len((r[1] or "").encode())), str(len(lib.encode(r[1] or "", add_special_tokens=False).ids))) for r in rows]
    assert by_row(token_counts(docs, BYTES), "doc_id", "tw_bytes", "tw_tokens") == sorted(want)


# --- 6: languages -----------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    found = queries.op6_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out")
    assert held.count() > 150 and held.where("lang_pred <> lang").count() / held.count() < 0.03
    assert found.where("score < 0 or score > 1 or lang_pred is null").count() == 0


def test_language_edge_cases(docs, nothing):
    model = fit(docs.where("doc_id is not null"), PIECES)
    got = {(r["doc_id"], r["tw_lang"], r["tw_score"] == 0) for r in identify(docs, model, PIECES).collect()}
    rows = corpus()[0]
    for r in rows:
        letters = any(map(str.isalpha, r[1] or ""))
        assert (r[0], "en" if letters else "und", not letters) in got
    assert fit(nothing, PIECES) == {} and {r["tw_lang"] for r in identify(docs, {}, PIECES).collect()} == {"und"}


def segmentations(word, pieces):
    """Every sequence of pieces that spells a word; a character that is no piece stands for itself (None)."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        piece = pieces.get(word[:n], len(pieces) if n == 1 else None)
        if piece is not None:
            yield from ((piece, *rest) for rest in segmentations(word[n:], pieces))


def test_forward_sums_and_expectations_against_enumeration():
    from tidewheel.llm.language_id import Lattice, Scores

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    kept = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): k for k, i in enumerate(kept)}
    p = np.random.default_rng(5).random((len(pieces) + 1, 3)) * 0.01
    words_ = ["the", "a", "season", "über", "x\u2603y", "the", "naïve", "ing"]
    ways = [list(segmentations("▁" + w, pieces)) for w in words_]
    assert max(map(len, ways)) > 8
    sums = [np.array([p[list(way)].prod(axis=0) for way in own]) for own in ways]
    lattice = Lattice(words_, PIECES)
    assert np.allclose(lattice.forward(p)[lattice.last], [s.sum(axis=0) for s in sums], rtol=1e-9)
    weights, want = np.arange(1.0, len(words_) + 1), np.zeros(len(pieces) + 1)
    for own, s, n in zip(ways, sums, weights):
        for way, share in zip(own, s[:, 0] / s[:, 0].sum()):
            np.add.at(want, list(way), share * n)
    assert np.allclose(lattice.expected(p[:, 0], weights), want)
    scores = Scores(p, PIECES)
    scores.learn(set(words_))
    assert np.allclose(scores.of(words_)[:-1], sum(np.log(s.sum(axis=0)) for s in sums))


def test_posterior(spark):
    """The score is the best language's share of all languages' products over the words."""
    from tidewheel.llm.language_id import Scores

    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("die katze sass auf der matte", "de"), ("le chat est sur le tapis", "fr")] * 5)], "doc_id long, text string, lang string")
    model = fit(docs, PIECES)
    found = identify(spark.createDataFrame([(0, "the matte"), (1, "12 34")], "doc_id long, text string"), model, PIECES).orderBy("doc_id").collect()
    scores = Scores(np.stack([model[x] for x in sorted(model)], axis=1), PIECES)
    scores.learn({"the", "matte"})
    logs = scores.of(["the", "matte"])[:-1]
    share = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
    assert found[0]["tw_lang"] == sorted(model)[int(share.argmax())] and abs(found[0]["tw_score"] - share.max()) < 1e-9
    assert (found[1]["tw_lang"], found[1]["tw_score"]) == ("und", 0.0)


# --- 7: repeats -------------------------------------------------------------------------------------


def removed(rows):
    """(id, text) -> (bytes, removed, spans, kept); rows equal in both are one document."""
    key = lambda r: (r[0] is not None, r[0] or 0)
    hashes = lambda t: 0 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    seen, out = set(), {}
    for r in sorted(set((r[0], r[1]) for r in rows), key=lambda r: (key(r), 42 if r[1] is None else signed(hashes(r[1])))):
        b = (r[1] or "").encode()
        cut = np.zeros(len(b), bool)
        for s in range(len(b) - suffix_dedup.LENGTH + 1):
            w = b[s : s + suffix_dedup.LENGTH]
            if w in seen:
                cut[s : s + suffix_dedup.LENGTH] = True
            else:
                seen.add(w)
        spans = int((cut & ~np.concatenate([[False], cut[:-1]])).sum()) if len(b) else 0
        out[r] = (len(b), int(cut.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~cut]))
    return out


def test_repeats(docs):
    rows = corpus()[0]
    want = removed(rows)
    got = sorted((str(r["doc_id"]), r["tw_bytes"], r["tw_removed"], r["tw_spans"], bytes(r["tw_kept"])) for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == sorted((str(r[0]), *want[(r[0], r[1])]) for r in rows)
    assert sum(x[2] for x in got) > 5000


def edged(n=900):
    """A passage in n documents, each with text of its own around it, and edits in some; ids from 1."""
    r = random.Random(9)
    say = lambda k: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(k))
    passage = say(40)
    return [(i + 1, f"{say(12)} {passage if i % 3 else passage[: 40 + i % 150] + 'x' + passage[41 + i % 150 :]} {say(12)}") for i in range(n)]


def test_repeats_with_edges_of_their_own(spark):
    """A passage in very many different surroundings: some cores are merged in shards, the crowded ones taken string by string."""
    rows = edged()
    found = []
    for i, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        out = suffix_dedup.find_segments(data, np.full(len(data), len(data)))
        out["id"] = i
        found.append(out)
    packed = pa.Table.from_batches(list(suffix_dedup._packed(np.concatenate(found), 4))).sort_by("bucket").combine_chunks().to_batches()
    resolved = list(suffix_dedup._resolve(iter(packed)))
    assert set(np.concatenate([b.column(1).to_numpy() for b in resolved]).tolist()) == {1, 2, 3}
    want = removed(rows)
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    got = {r["doc_id"]: (r["tw_bytes"], r["tw_removed"], r["tw_spans"], bytes(r["tw_kept"])) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {i: want[(i, t)] for i, t in rows}


def test_repeats_of_odd_ids_and_columns(spark):
    long_ = "some words that are said again and again, " * 4
    rows = [(None, long_, "a"), (-(1 << 63), long_, "b"), (5, long_, "c"), (5, "x" + long_, "d"), (5, "x" + long_, "d"), (6, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tw_cuts string").repartition(3)
    got = sorted((str(r["doc_id"]), r["tw_cuts"], r["tw_bytes"], r["tw_removed"], r["tw_spans"]) for r in suffix_dedup.remove_repeats(docs, keep=("tw_cuts",)).collect())
    low = -(1 << 63)
    want = removed([(low if i is None else i, t) for i, t, _ in rows])
    assert got == sorted((str(i), c, *want[(low if i is None else i, t)][:3]) for i, t, c in rows)
    with pytest.raises(TypeError, match="whole numbers"):
        suffix_dedup.remove_repeats(docs.withColumn("doc_id", F.col("tw_cuts")))


def test_repeats_memory_of_a_uniform_text():
    """32 MiB of one letter: a record for each byte is folded piece by piece."""
    body = """
import numpy as np, pyarrow as pa
from tidewheel.llm import suffix_dedup as S
batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array(["a" * (32 << 20)])], ["id", "row", "text"])
"""
    call = "found = list(S._collect(8)(iter([batch]))); assert sum(b.num_rows for b in found) > 0"
    assert megabytes(body, call) < 1000


def test_share_of_the_merge(spark):
    """What of the removed bytes is found by the merge alone, on the driver's documents, with no constant changed."""
    from tidewheel.llm import common

    at = common.mark()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total = suffix_dedup.remove_repeats(docs).agg(F.sum("tw_removed")).first()[0]
    repeats, merged = (spark.read.parquet(p) for p in common._WRITTEN[at:])

    def covered(df):
        spans: dict = {}
        for r in df.where("kind = 1").collect():
            spans.setdefault((r["id"], r["row"]), []).append(np.frombuffer(bytes(r["data"]), "<i8").reshape(-1, 2))
        return {k: suffix_dedup.merge_spans(np.concatenate(v)) for k, v in spans.items()}

    size = lambda spans: sum(int((s[:, 1] - s[:, 0]).sum()) for s in spans.values())
    folded, found = covered(repeats), covered(merged)
    both = {k: suffix_dedup.merge_spans(np.concatenate([x[k] for x in (folded, found) if k in x])) for k in folded | found}
    assert size(both) == total
    share = (total - size(folded)) / total
    assert share > 0.02, share
    print("share of the merge", share, "covered by it", size(found) / total)


@pytest.mark.parametrize("seed", range(3))
def test_merged_shards_find_all_repeats(seed):
    r = random.Random(seed)
    base = [bytes(r.choice(b"ab") for _ in range(300)) for _ in range(3)]
    segments = [x[r.randint(0, 100) : r.randint(150, 300)] for x in base for _ in range(8)]
    own = suffix_dedup.Shards(segments, shard_bytes=400)
    place, block = own.repeated()
    joined, want = b"".join(segments), {}
    for s in range(len(segments)):
        for p in range(int(own.start[s]), int(own.start[s + 1]) - suffix_dedup.LENGTH + 1):
            want.setdefault(joined[p : p + suffix_dedup.LENGTH], []).append(p)
    groups = {}
    for p, b in zip(place.tolist(), block.tolist()):
        groups.setdefault(b, []).append(p)
    assert sorted(map(sorted, groups.values())) == sorted(v for v in want.values() if len(v) > 1)


# --- 8: archives ------------------------------------------------------------------------------------


def test_archives(spark):
    big = "<p>" + "é" * 300
    data = [(i, f"http://x/{i}", h) for i, h in enumerate([big, big, "small", "small", None, "", "z" * 100, "z" * 100, "y" * 99, "y" * 99])]
    data += [(20, None, big), (21, "http://a b\r\nX: y", "w" * 50_000), (20, "http://again", big), (None, "u", "q" * 200)]
    folder = new_path(spark, "warc-test")
    made = warc.write_archives(spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit("x")), folder)
    assert made.agg(F.sum("records")).first()[0] == len(data)
    rows = warc.read_archives(spark, folder, with_payload=True).collect()
    want = sorted((str(i), "revisit" if (h == big and i) or i == 7 else "response", str(0 if h == big and i else 6 if i == 7 else None), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in data)
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"], r["payload_digest"]) for r in rows) == want
    payloads = {r["page_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    assert payloads[0] == big.encode() and payloads[21] == b"w" * 50_000 and payloads[4] == b""


def test_an_archive_is_placed_once(tmp_path):
    """Two attempts of a task, on a store that does not rename onto a file and on one that does."""
    import pyarrow.fs

    class Strict:
        def __init__(self, seen):
            self.own, self.seen = pyarrow.fs.LocalFileSystem(), seen

        def __getattr__(self, name):
            return getattr(self.own, name)

        def get_file_info(self, path):
            return self.own.get_file_info(path if self.seen else f"{path}.none")

        def move(self, a, b):
            self.seen = True
            if Path(b).exists():
                raise OSError("the target exists")
            self.own.move(a, b)

    for store in (pyarrow.fs.LocalFileSystem(), Strict(True), Strict(False)):
        name = f"{tmp_path}/{id(store)}.warc.zst"
        for attempt in range(2):
            Path(f"{name}.{attempt}.tmp").write_bytes(b"archive")
            warc.place(store, f"{name}.{attempt}.tmp", name)
        assert Path(name).read_bytes() == b"archive" and not list(tmp_path.glob("*.tmp"))


def broken(raw, how):
    with pytest.raises(ValueError, match=how):
        list(warc.records_of(raw))


def test_reader_validates():
    rec = warc.page_record(1, "http://x", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None)
    good = warc.archive([rec, rec], [b"payload " * 50] * 20)
    assert [h["warc-type"] for _, h, _ in warc.records_of(good)] == ["response"] * 2
    broken(good[:-9], "cut off")
    broken(good + b"junk", "no Zstandard frame")
    broken(warc.archive([rec.replace(b"WARC/1.1", b"WARC/9.9")], []), "version line")
    broken(warc.archive([re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"Content-Length: 5\r\n\r\nHTTP", rec)], []), "does not match")
    broken(warc.archive([rec.replace(b"WARC-Date", b"WARC-Dote")], []), "mandatory")
    _, headers, block = next(warc.records_of(warc.archive([rec.replace(b"payload", b"PAYLOAD")], [])))
    with pytest.raises(ValueError, match="digest"):
        warc.page_of(headers, block)


def test_reader_takes_compressed_dictionaries():
    import struct

    import zstandard

    rec = warc.page_record(1, "http://x", b"", 0, hashlib.sha256(b"").hexdigest(), None)
    good = warc.archive([rec], [b"abcdefgh" * 40] * 30)
    size = struct.unpack_from("<I", good, 4)[0]
    packed = zstandard.compress(good[8 : 8 + size])
    again = struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed + good[8 + size :]
    assert len(list(warc.records_of(again))) == 1


# --- 10: near copies --------------------------------------------------------------------------------


def fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, ids, threshold=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(set(prints))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= threshold:
                parent[find(b)] = find(a)
    low = {}
    for p, i in zip(prints, ids):
        if i is not None:
            low[find(p)] = min(low.get(find(p), i), i)
    return [low.get(find(p)) for p in prints]


def test_near_copies(docs):
    rows = corpus()[0]
    prints = [fingerprint(r[1]) for r in rows]
    want = sorted((str(r[0]), f"{p:016x}", str(c)) for r, p, c in zip(rows, prints, components(prints, [r[0] for r in rows])))
    got = near_copies(docs).select("doc_id", F.lpad(F.lower(F.hex("tw_print")), 16, "0").alias("p"), "tw_component")
    assert sorted(tuple(map(str, r)) for r in got.collect()) == want


def test_spread_join(spark):
    from tidewheel.llm.common import spread_join

    many = spark.createDataFrame([(0, i) for i in range(500)] + [(i, i) for i in range(1, 40)], "k long, v long")
    one = spark.createDataFrame([(i, i * 10) for i in range(0, 40, 2)], "k long, w long")
    joined = spread_join(many, one, "k", many.groupBy("k").agg(F.count("*").alias("n")))
    assert "Union" in joined._jdf.queryExecution().toString()
    assert sorted(map(tuple, joined.select("k", "v", "w").collect())) == sorted((k, v, k * 10) for k, v in map(tuple, many.collect()) if k % 2 == 0)


@pytest.mark.parametrize("held", [50_000, 5])
def test_links_are_complete(spark, held, monkeypatch):
    """Random clusters of fingerprints, chains among them; the second run splits crowded anchors."""
    from tidewheel.llm import simhash

    monkeypatch.setattr(simhash, "HELD", held)
    r = random.Random(6)
    prints = [r.getrandbits(64) for _ in range(150)]
    for p in prints[:10]:
        now = p
        for _ in range(25):
            now ^= sum(1 << b for b in r.sample(range(64), r.randint(0, 3)))
            prints.append(now)
    signed = sorted({p - (1 << 64) if p >= 1 << 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    got = dict(tuple(x) for x in roots(simhash.links(df)).collect())
    unsigned = [p % (1 << 64) for p in signed]
    want = components(unsigned, signed)
    assert [got.get(p, p) for p in signed] == want


# --- all: nothing in, nothing out -------------------------------------------------------------------


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = new_path(spark, "warc-empty")
    assert warc.write_archives(pages, folder).count() == 0 and warc.read_archives(spark, folder).count() == 0
    results = [pii.pseudonymise(nothing, "k"), decontamination.contamination(nothing, bench), line_dedup.dedup_lines(nothing), encode_decode(nothing, PIECES), identify(nothing, {}, PIECES), suffix_dedup.remove_repeats(nothing), token_counts(nothing, BYTES), near_copies(nothing)]
    assert [r.count() for r in results] == [0] * 8


def test_no_benchmark(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    found = decontamination.contamination(docs, bench)
    assert found.count() == len(corpus()[0]) and found.where("tw_hit > 0").count() == 0


def test_cleanup_removes_written_tables(spark):
    from tidewheel.llm import common

    at = common.mark()
    result = near_copies(spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id long, text string")).collect()
    made = common._WRITTEN[at:]
    assert len(result) == 2 and made and all(Path(p.replace("file:", "")).exists() for p in made)
    assert common.cleanup(at) == len(made) and not any(Path(p.replace("file:", "")).exists() for p in made) and common.mark() == at


def test_pseudonyms_in_long_and_repeated_texts(spark):
    long_ = "word 12 " * 200_000 + "card 4111 1111 1111 1111 end"
    (a, n), (b, _), (c, _) = named(spark, [long_, "4111 1111 1111 1111", "4111 1111 1111 1111"])
    assert n == 1 and b == c and a == long_.replace("4111 1111 1111 1111", b)
    df = spark.createDataFrame([(1, "x", "y", "1999-12-31")], "doc_id long, tw_in string, tw_found string, text string")
    assert pii.pseudonymise(df, "k", keep=("tw_in", "tw_found", "text")).select("tw_in", "tw_found", "text").first() == ("x", "y", "1999-12-31")


def test_buffers_of_slices():
    from tidewheel.llm.common import buffers, byte_rows

    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["a", None, "bcd", "", "é"], kind).slice(1)
        assert byte_rows(column) == [b"", b"bcd", b"", "é".encode()] and buffers(column)[0].tolist()[-1] >= 5
