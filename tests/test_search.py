import math
import random
import re
from collections import Counter

import pytest

from docgate.operators import prompts, search
from docgate.sources.tables import read_postings, save_chunk_table, save_postings
from docgate.operators.chunks import chunk_counts
from pyspark.sql import functions as F

SCHEMA = "doc_id string, chunk_no int, chunk_text string, source_url string"


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


@pytest.fixture(scope="module")
def corpus():
    """Most chunks hold the hot word, rare words are rare; texts of uneven length, some equal."""
    rng = random.Random(3)
    rare = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        text = [w for w in ("hot", "Hot", "warm") if rng.random() < 0.6]
        text += rng.choices(rare, weights=[1 / (n + 1) for n in range(60)], k=rng.randint(0, 25))
        rng.shuffle(text)
        # Several chunks share a key, as those of messages without a trace id do.
        rows.append((f"d{i % 45}", i // 90, rng.choice([" ", ", ", "-", "_"]).join(text), f"u{i}"))
    return rows


@pytest.fixture(scope="module")
def asked():
    rng = random.Random(5)
    pool = ["hot", "warm", "HOT", "absent"] + [f"w{i}" for i in range(60)]
    questions = [" ".join(rng.choices(pool, k=rng.randint(1, 5))) + "?" for _ in range(60)]
    return list(enumerate(["hot", "hot warm", "absent", "", "?!", *questions]))


@pytest.fixture(scope="module")
def chunks(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def questions(spark, asked):
    return spark.createDataFrame(asked, "question_id long, question string").cache()


def brute_all_terms(corpus, asked, k):
    found = []
    for qid, question in asked:
        wanted = set(words(question))
        hits = sorted((c[0], c[1]) for c in corpus if wanted and wanted <= set(words(c[2])))
        found += [(qid, rank, *key) for rank, key in enumerate(hits[:k], 1)]
    return sorted(found)


def brute_ranked(corpus, asked, k):
    bags = [((c[0], c[1]), Counter(words(c[2]))) for c in corpus]
    mean = sum(sum(b.values()) for _, b in bags) / len(bags)
    df = Counter(w for _, b in bags for w in b)
    found = {}
    for qid, question in asked:
        scores = []
        for key, bag in bags:
            hit = [w for w in set(words(question)) if bag[w]]
            score = sum(
                math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5))
                * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * sum(bag.values()) / mean))
                for w in hit
            )
            if hit:
                scores.append((-round(score, 6), key))
        for rank, (score, key) in enumerate(sorted(scores)[:k], 1):
            found[qid, rank] = (*key, -score)
    return found


@pytest.mark.parametrize("limit", [search.BROADCAST_LIMIT, 0])
def test_batch_equals_brute_force(chunks, questions, corpus, asked, limit):
    got = search.search_batch(chunks, questions, 3, broadcast_limit=limit).collect()
    assert sorted(map(tuple, got)) == brute_all_terms(corpus, asked, 3)


@pytest.mark.parametrize("limit", [search.BROADCAST_LIMIT, 0])
def test_batch_carries_chunk_columns(chunks, questions, corpus, asked, limit):
    got = search.search_batch(chunks, questions, 2, ("source_url", "chunk_text"), limit)
    rows = got.collect()
    assert got.columns == ["question_id", "rank", "doc_id", "chunk_no", "source_url", "chunk_text"]
    assert rows and all(
        (r["doc_id"], r["chunk_no"], r["chunk_text"], r["source_url"]) in corpus for r in rows
    )
    asks = dict(asked)
    assert all(set(words(asks[r["question_id"]])) <= set(words(r["chunk_text"])) for r in rows)


@pytest.mark.parametrize("limit", [search.BROADCAST_LIMIT, 0])
@pytest.mark.parametrize("k", [1, 50])
def test_ranked_equals_brute_force(chunks, questions, corpus, asked, limit, k):
    rows = search.search_ranked(chunks, questions, k, broadcast_limit=limit).collect()
    got = {(r["question_id"], r["rank"]): (r["doc_id"], r["chunk_no"], r["score"]) for r in rows}
    want = brute_ranked(corpus, asked, k)
    assert len(rows) == len(want) and got.keys() == want.keys()
    for at, (doc_id, chunk_no, score) in want.items():
        assert got[at][:2] == (doc_id, chunk_no), at
        assert got[at][2] == pytest.approx(score, abs=2e-6)


@pytest.mark.parametrize("limit", [search.BROADCAST_LIMIT, 0])
def test_equal_chunks_are_hits_of_their_own(spark, limit):
    rows = [("e", 0, "alpha one", "u"), ("e", 0, "beta two", "u"), ("e", 0, "alpha beta", "u"),
            ("e", 0, "alpha beta", "v"), ("f", 0, "alpha one", "u")]
    df = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(1, "alpha beta"), (2, "two one")], "question_id long, question string")
    hits = search.search_batch(df, asked, 5, ("source_url",), limit).collect()
    assert sorted((r["question_id"], r["source_url"]) for r in hits) == [(1, "u"), (1, "v")]
    ranked = search.search_ranked(df, asked, 5, broadcast_limit=limit).collect()
    assert Counter(r["question_id"] for r in ranked) == {1: 5, 2: 3}
    assert ranked == search.search_ranked(df, asked, 5).collect()


def brute_any_word(corpus, asked, k):
    found = []
    for qid, question in asked:
        wanted = [w.lower() for w in question.split()]
        hits = sorted((c[0], c[1]) for c in corpus if any(w in c[2].lower() for w in wanted))
        found += [(qid, rank, *key) for rank, key in enumerate(hits[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("limit", [search.BROADCAST_LIMIT, 0])
@pytest.mark.parametrize("k", [3, 40])
def test_any_word_batch_equals_brute_force(spark, chunks, questions, corpus, asked, limit, k):
    got = search.search_any_word_batch(chunks, questions, k, broadcast_limit=limit).collect()
    assert sorted(map(tuple, got)) == brute_any_word(corpus, asked, k)


def test_any_word_batch_takes_short_words_marks_and_any_script(spark):
    rows = [("a", 0, "Straße é 東京都 x", "u"), ("a", 1, "100% of it_all", "u"), ("a", 1, "100% of it_all", "v"),
            ("b", 0, "aaaa \U0001d11e\U0001d11e!", "u"), ("c", 0, "", "u"), ("d", 0, None, "u"), ("e", 0, "É", "u")]
    texts = ["é", "京", "京都", "東京都", "0% t_a", "aaa", "\U0001d11e", "\U0001d11e\U0001d11e!", "STRASSE STRAß",
             "zz\u3000é\u2028zz", "\xa0 \x1c", "", "it it_all 100%", "x aa of"]
    asked = list(enumerate(texts))
    df, questions = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(
        [*asked, (99, None)], "question_id long, question string")
    for k in (1, 2, 9):
        got = search.search_any_word_batch(df, questions, k).collect()
        assert sorted(map(tuple, got)) == brute_any_word([r for r in rows if r[2] is not None], asked, k)
    carried = search.search_any_word_batch(df, questions, 9, ("source_url",)).where("question_id = 12").collect()
    assert [r["source_url"] for r in sorted(carried, key=lambda r: r["source_url"])] == ["u", "v"]


def test_any_word_batch_meets_words_not_pairs_of_questions(chunks, questions, plan):
    found = plan(search.search_any_word_batch(chunks, questions))
    # The first k of each word are cut before they are exchanged, and only these meet the questions.
    assert "BroadcastHashJoin" in found and found.count("row_number(), 5, Partial") >= 3


@pytest.mark.parametrize("head", [1, 5, 90])
def test_frequent_words_are_settled_by_the_first_chunks(
    spark, chunks, questions, corpus, asked, monkeypatch, head
):
    monkeypatch.setattr(search, "_HEAD", head)
    searched = []
    whole = search._first_of_words
    monkeypatch.setattr(
        search, "_first_of_words",
        lambda chunks, words, *rest: searched.append({r[0] for r in words.collect()}) or whole(chunks, words, *rest),
    )
    got = search.search_any_word_batch(chunks, questions, 3).collect()
    assert sorted(map(tuple, got)) == brute_any_word(corpus, asked, 3)
    # The hits of a word that most chunks hold are not all put in order.
    every, late = searched
    assert "hot" in every and ("hot" in late) == (head < 3)
    assert "absent" in late


def test_stored_postings_answer_without_the_chunks(spark, chunks, questions, plan, tmp_path):
    save_postings(chunks, "some_postings", 4, str(tmp_path))
    counted, stats = read_postings(spark, "some_postings")
    want = search.corpus_stats(chunks)
    assert set(map(tuple, stats.collect())) == set(map(tuple, want.collect()))
    for limit in (search.BROADCAST_LIMIT, 0):
        got = search.search_ranked(None, questions, 7, stats, limit, counted).collect()
        assert set(got) == set(search.search_ranked(chunks, questions, 7).collect())
    stored = plan(search.search_ranked(None, questions, 5, stats, counted=counted))
    # Only the two steps of the top k: no exchange of the corpus, no texts.
    assert stored.count("Exchange hashpartitioning") == 2
    assert "chunk_text" not in stored and "regexp_extract_all" not in stored
    with pytest.raises(ValueError):
        search.search_ranked(None, questions)


def test_postings_are_stored_once_per_chunk(spark, chunks, corpus, tmp_path):
    save_postings(chunks, "whole_postings", 3, str(tmp_path))
    rows = read_postings(spark, "whole_postings")[0].collect()
    # A chunk's key is not repeated with each of its words.
    assert len(rows) == len({r[:3] for r in corpus})
    stored = Counter((r["doc_id"], r["chunk_no"], tuple(zip(r["terms"], r["tfs"])), r["length"]) for r in rows)
    counted = {r[:3]: Counter(words(r[2])) for r in corpus}
    assert stored == Counter(
        (*key[:2], tuple(sorted(bag.items())), sum(bag.values())) for key, bag in counted.items()
    )


def test_a_very_long_question_goes_with_short_ones(spark, chunks):
    long = " ".join(f"w{n}" for n in range(5000))
    asked = spark.createDataFrame([(1, long), (2, "hot")], "question_id long, question string")
    ranked = search.search_ranked(chunks, asked, 3).collect()
    assert Counter(r["question_id"] for r in ranked) == {1: 3, 2: 3}
    assert {r["question_id"] for r in search.search_batch(chunks, asked).collect()} == {2}


def test_statistics_can_be_reused_for_other_questions(spark, chunks, questions):
    stats = search.corpus_stats(chunks)
    again = search.search_ranked(chunks, questions, 2, stats=stats).collect()
    assert set(again) == set(search.search_ranked(chunks, questions, 2).collect())
    other = spark.createDataFrame([(1, "w7")], "question_id long, question string")
    assert search.search_ranked(chunks, other, 2, stats=stats).count() == 2


def test_ranked_on_an_empty_corpus(chunks, questions):
    assert search.search_ranked(chunks.limit(0), questions).count() == 0


def test_single_query_forms(spark):
    df = spark.createDataFrame(
        [
            ("doc-1", 0, "Ordering keys allow message ordering.", "u1"),
            ("doc-2", 0, "Disordering keysets", "u2"),
            ("doc-3", 0, "keys, then: ORDERING", "u3"),
            ("doc-4", 0, "100% of it_all", "u4"),
        ],
        SCHEMA,
    )
    ids = lambda found: [r["doc_id"] for r in found.collect()]
    assert ids(search.search_all_terms(df, "ordering keys")) == ["doc-1", "doc-3"]
    assert ids(search.search_any_word(df, "ordering keys")) == ["doc-1", "doc-2", "doc-3"]
    assert ids(search.search_any_word(df, "0%")) == ["doc-4"]
    assert ids(search.search_any_word(df, "% x_x")) == ["doc-4"]
    assert ids(search.search_any_word(df, "a1 a2 a3 a4 a5 ordering")) == ["doc-1", "doc-2", "doc-3"]
    assert ids(search.search_any_word(df, "a1 ordering", max_words=1)) == []
    assert ids(search.search_any_word(df, "it's o'clock")) == []
    for query in ("", " ", "?!"):
        assert ids(search.search_all_terms(df, query)) == []
    assert ids(search.search_any_word(df, "  ")) == []
    assert search.search_chunks(df, "keys", 1).collect() == [
        ("doc-1", "Ordering keys allow message ordering.", "u1")
    ]
    assert len(ids(search.search_chunks(df, "keys", 20, "any_word"))) == 3


@pytest.mark.parametrize("top_k", [0, -1])
def test_top_k_is_checked(chunks, questions, top_k):
    for call in (
        lambda: search.search_all_terms(chunks, "hot", top_k),
        lambda: search.search_any_word(chunks, "hot", top_k),
        lambda: search.search_batch(chunks, questions, top_k),
        lambda: search.search_ranked(chunks, questions, top_k),
        lambda: search.search_any_word_batch(chunks, questions, top_k),
    ):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError):
        search.search_chunks(chunks, "hot", mode="fuzzy")


def test_plans_exchange_only_top_k_rows(chunks, questions, plan):
    batch = plan(search.search_batch(chunks, questions))
    assert "BroadcastHashJoin" in batch
    # Two exchanges, each behind a cut to k rows per question: lanes, then their winners.
    assert batch.count("Exchange hashpartitioning") == 2
    assert batch.count("row_number(), 5, Partial") == 2
    # A chunk is split into words once.
    assert batch.split("BroadcastExchange")[0].count("regexp_extract_all") == 1
    single = plan(search.search_all_terms(chunks, "hot"))
    assert "TakeOrderedAndProject" in single and "hashpartitioning" not in single
    shuffled = plan(search.search_batch(chunks, questions, broadcast_limit=0))
    assert "row_number(), 5, Partial" in shuffled


def test_ranking_exchanges_chunks_once_and_no_pairs(chunks, questions, plan):
    ranked = plan(search.search_ranked(chunks, questions, stats=search.corpus_stats(chunks)))
    # Whole chunks, then the two steps of the top k.
    assert ranked.count("Exchange hashpartitioning") == 3


def test_ranking_keeps_no_pairs_of_chunk_and_question(spark, chunks, questions, plan):
    stats = search.corpus_stats(chunks)
    save_postings(chunks, "pairless_postings", 2)
    stored = read_postings(spark, "pairless_postings")[0]
    for found in (
        search.search_ranked(chunks, questions, stats=stats),
        search.search_ranked(None, questions, stats=stats, counted=stored),
    ):
        assert "Aggregate(keys=[question_id" not in plan(found)


def test_ranking_takes_chunks_of_one_task_in_several_steps(spark, chunks, questions):
    whole = search.search_ranked(chunks.coalesce(1), questions, 4).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert search.search_ranked(chunks.coalesce(1), questions, 4).collect() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("limit, long", [(700, True), (2000, False)])
def test_questions_too_many_to_broadcast_are_scored_in_parts(
    spark, chunks, asked, monkeypatch, tmp_path, limit, long
):
    pool = [*asked[:14], (6, "hot w3"), (None, "w1 w2 warm"), (900, " ".join(f"w{n}" for n in range(9)))]
    questions = spark.createDataFrame(pool, "question_id long, question string")
    want = search.search_ranked(chunks, questions, 4).collect()
    save_postings(chunks, f"parted_postings_{limit}", 2, str(tmp_path))
    counted, stats = read_postings(spark, f"parted_postings_{limit}")
    pairs, parts = [], []
    best, all_totals = search.best, search._all_totals
    monkeypatch.setattr(search, "best", lambda *a: parts.append(a[1].collect()) or best(*a))
    monkeypatch.setattr(search, "_all_totals", lambda *a: pairs.append(a[1]) or all_totals(*a))
    for given in ((chunks, questions, 4, None, limit), (None, questions, 4, stats, limit, counted)):
        parts.clear()
        got = search.search_ranked(*given)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))
        # Pairs of chunk and question are exchanged for questions that are too long by themselves.
        assert ("Aggregate(keys=[question_id" in got._jdf.queryExecution().toString()) == long
        sizes = [sum(len(r["term"].encode()) + 64 for r in part) for part in parts]
        assert len(parts) > 1 and max(sizes) <= limit
        of = [{r["question_id"] for r in part} for part in parts]
        assert sum(map(len, of)) == len(set.union(*of)) and None in set.union(*of)
        assert (900 in set.union(*of)) != long
        if long:
            assert {r["question_id"] for r in pairs[-1].collect()}.isdisjoint(set.union(*of))


def test_counts_on_a_bucketed_table_need_no_exchange(spark, chunks, plan):
    rows = chunks.withColumn("ingested_at", F.current_timestamp()).withColumn("embedding", F.lit("{}"))
    save_chunk_table(rows, "bucketed_chunks", 4)
    counts = chunk_counts(spark.table("bucketed_chunks"))
    assert "Exchange" not in plan(counts)
    assert counts.count() == 45


def test_prompts(spark):
    asked = spark.createDataFrame([(1, "What?"), (2, "Who?")], "question_id long, question string")
    hits = spark.createDataFrame(
        [(1, 2, "u2", "second"), (1, 1, "u1", "first")],
        "question_id long, rank int, source_url string, chunk_text string",
    )
    rows = {r["question_id"]: r for r in prompts.rag_prompts(asked, hits).collect()}
    assert rows[1]["prompt"] == "Context:\n[u1]\nfirst\n\n[u2]\nsecond\n\nQuestion: What?"
    assert rows[1]["prompt_len"] == len(rows[1]["prompt"])
    assert rows[1]["fixed_answer"] is None
    assert rows[2]["prompt"] is None
    assert rows[2]["fixed_answer"] == "I don't have enough information — no relevant chunks found."
