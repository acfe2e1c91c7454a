"""Work that stays within bounds: repeated words, long runs of digits, queries shipped to groups."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import decontamination, pii, suffix_dedup, topk
from tidewheel.llm.common import written

#: What a phone is, with groups that may be cut in any way; the library's pattern cuts them in one.
PHONE = r"\+\d(?:[ .-]?\(?\d{1,4}\)?){2,10}(?!\d)"


def brute(text, items):
    words = text.split()
    hit, found = np.zeros(len(words), bool), []
    for item, own in items:
        n = min(decontamination.WINDOW, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        at = [p for p in range(len(words) - n + 1) if tuple(words[p : p + n]) in windows] if n else []
        for p in at:
            hit[p : p + n] = True
        found += [item] * bool(at)
    return len(words), hit.tolist(), found


@pytest.mark.parametrize("seed", range(6))
def test_hits_with_repeated_words(seed):
    r = random.Random(seed)
    say = lambda n, k: " ".join(r.choice("abcdefgh"[:k]) for _ in range(n))
    text = say(400, 2) + " " + say(60, 1) + " " + say(300, 8)
    words = text.split()
    items = [(str(i), words[a : a + n]) for i, (a, n) in enumerate([(0, 13), (3, 20), (3, 20), (390, 40), (700, 3), (500, 0)])] + [("x", say(30, 2).split()), ("y", ["zz"] * 20), ("z", say(2, 8).split())]
    n, hit, found = decontamination.extend(text.encode(), [(i, [w.encode() for w in own]) for i, own in items])
    assert (n, hit.tolist(), found) == brute(text, items)


def test_one_word_a_hundred_thousand_times():
    began = time.time()
    n, hit, found = decontamination.extend(b"a " * 100_000, [("x", [b"a"] * 1000)])
    assert (n, hit.sum(), found) == (100_000, 100_000, ["x"]) and time.time() - began < 2


def test_phones_are_what_they_were(spark):
    r = random.Random(4)
    texts = ["".join(r.choice(["+", "1", "2", "3", "45", "678", "9012", "12345", " ", "-", "(", ")", ".", "x"]) for _ in range(r.randint(3, 26))) for _ in range(8000)]
    texts += ["+" + "".join(r.choice(["1", "2", "33", "444", "5555", " ", "-", "(", ")", "."]) for _ in range(r.randint(3, 22))) for _ in range(8000)]
    found = lambda p: F.regexp_extract_all("t", F.lit(f"(?=({p}))"), F.lit(1))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", found(PHONE).alias("a"), found(pii._PATTERNS["phone"]).alias("b"))
    assert df.where("size(a) > 0").count() > 3000 and df.where("a <> b").collect() == []


def test_long_runs_of_digits(spark):
    """A megabyte of runs of 60 digits: half an hour when groups could be cut in any way."""
    df = spark.createDataFrame([(1, ("+" + "1234567890" * 6 + " ") * 16_000)], "doc_id long, text string")
    began = time.time()
    assert pii.pseudonymise(df, "k").first()["tw_values"] == 0 and time.time() - began < 30


@pytest.mark.parametrize("span", [4096, 3])
def test_queries_go_to_few_groups(spark, monkeypatch, span):
    """On vectors in clusters most groups' maxima are below a query's floor: such queries are not shipped there."""
    monkeypatch.setattr(topk, "SPAN", span)
    monkeypatch.setattr(topk, "GROUP", 64)
    r = np.random.default_rng(5)
    centres = np.eye(16)
    rows = [(i, [float(x) for x in centres[i % 16] * 3 + r.normal(size=16) * 0.05]) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    shipped, pairs = [], []

    def asked(made, width, own=topk.asked_of):
        out = written(own(made, width), "asked")
        shipped.append(sum(len(x["ids"]) // 16 for x in out.collect()))
        queries = sum(len(x["ids"]) // 16 for x in made.where("kind = 1").collect())
        pairs.append(queries * made.where("kind = 0").count())
        return out

    monkeypatch.setattr(topk, "asked_of", asked)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0).collect()
    ints = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64)
    for q in range(0, 1600, 20):
        scores = ints @ ints[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:5]
        assert [(-x["score"], x["vec_id"]) for x in sorted(got, key=lambda x: x["rank"]) if x["query_id"] == q] == best
    assert pairs[0] >= 80 * 20 and shipped[0] < 0.25 * pairs[0]


def test_gathers_are_cut(monkeypatch):
    r = np.random.default_rng(9)
    rows = r.integers(-500, 500, (300, 12))
    whole = topk.Group(np.arange(300), rows).search(rows[:40], np.full(40, topk.NONE), 5, np.arange(40))
    monkeypatch.setattr(topk, "GATHER", 1)
    cut = topk.Group(np.arange(300), rows).search(rows[:40], np.full(40, topk.NONE), 5, np.arange(40))
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


# --- op7: hot cores -----------------------------------------------------------------------------------


def cut(rows):
    """(id, bytes, removed, spans, kept) by brute force; ids are distinct, None is the smallest."""
    seen, out, n = set(), [], suffix_dedup.LENGTH
    for id_, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - n + 1):
            if b[s : s + n] in seen:
                gone[s : s + n] = True
            seen.add(b[s : s + n])
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((str(id_), len(b), int(gone.sum()), int((edge == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


@pytest.mark.parametrize("hot", [1, 6, 40])
def test_hot_cores_against_brute_force(spark, monkeypatch, hot):
    """Passages of 70 to 300 bytes in many surroundings, copies, a text that repeats itself; most cores are hot with 1."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    r = random.Random(11)
    say = lambda n: "".join(r.choice("abcdefghijklmnopqrst ") for _ in range(n))
    shared = [say(n) for n in (70, 80, 99, 100, 120, 300)]
    texts = [say(r.randint(0, 90)) + r.choice(shared) + say(r.randint(0, 90)) + r.choice(shared) + say(5) for _ in range(120)]
    texts += [texts[3]] * 4 + ["ab" * 400, say(400) * 2, None, "", shared[5], "x" * 350]
    rows = list(enumerate(texts)) + [(None, texts[5])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((str(x["doc_id"]), x["tw_bytes"], x["tw_removed"], x["tw_spans"], bytes(x["tw_kept"])) for x in got) == cut(rows)


def test_a_line_in_all_documents_is_not_one_tasks(spark):
    """20,000 documents share an 80-byte line, so its cores have 20,000 different segments each: no bucket gets them."""
    line = "This line of eighty bytes, neither more nor less, is found in every document ok."
    assert len(line) == 80
    noise = lambda seed: F.concat(*(F.sha2(F.concat(F.lit(f"{seed}{k} "), F.col("id").cast("string")), 256) for k in range(3)))
    docs = spark.range(20_000).select(F.col("id").alias("number"), F.lit(0).cast("long").alias("own_row"), F.concat(noise("a"), F.lit(line), noise("b")).alias("own_text")).repartition(8)
    counts = docs.mapInArrow(suffix_dedup._crowds, "core long, n long").groupBy("core").agg(F.sum("n").alias("n")).where("n > 1000").collect()
    hot = np.sort(np.array([x["core"] for x in counts], np.int64).view(np.uint64))
    assert 1 <= len(hot) < 100 and max(x["n"] for x in counts) > 10_000

    def sizes(hot):
        dealt = docs.mapInArrow(suffix_dedup._collect(64, hot), suffix_dedup._DEALT).where("kind <> 1")
        return [x["size"] for x in dealt.groupBy("bucket").agg(F.sum(F.octet_length("data")).alias("size")).collect()]

    even, uneven = sizes(hot), sizes(hot[:0])
    assert max(uneven) > 4 * sum(uneven) / len(uneven)  # what it was
    assert len(even) == 64 and max(even) < 2 * sum(even) / len(even)
