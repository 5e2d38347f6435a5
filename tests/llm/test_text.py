"""Token, line, chat and quality operators against plain versions."""

import hashlib
import random
import re
from array import array
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docgate.llm import bpe, chat, line_quality, mixing, subword_classifier, suffix_dedup, token_count

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", " a  b\n\n c\t\td", "it's 'S don't\r\n\r\n  foo", "trail   ", "x\x00y  z",
    "x<|endoftext|>y <|endoftext|>  <|endoftext|>", "<|startoftext|>A<|ENDOFTEXT|> b", "<|endoftext|",
    "é 日本 　  b", "   b 　   c   d  é  ñ è à  ", "\u0085  x", "\x1c\x1d a\x1fb c",
    "İ ΑΣ ΣΑ. x", "a ́b", "ab " * 50_000, "y" * 30_000, "a", "😀 👍🏽\n\n\n  ok",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "clash", 1.0) for n, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids_of string, score_ double")


def test_encoding_equals_the_library_and_round_trips(docs):
    encoded = bpe.encode(docs, BYTES)
    library = Tokenizer.from_file(BYTES)
    ids = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    texts = {r["doc_id"]: r["decoded"] for r in bpe.decode(encoded, BYTES).collect()}
    for n, text in enumerate(TEXTS):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids[n] == expected
        assert texts[n] == library.decode(expected, skip_special_tokens=False)


def test_decoding_null_and_broken_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [447])], "doc_id bigint, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, BYTES).collect()}
    assert found[1] == found[2] == ""
    assert "�" in found[3]


def test_counts_equal_the_library(docs):
    library = Tokenizer.from_file(WORDS)
    for r in token_count.count_tokens(docs, WORDS).collect():
        text = TEXTS[r["doc_id"]] or ""
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)


def test_pieces_put_together_are_the_text():
    text = "ab c\n" * 1000 + "d" * 500 + " e"
    assert "".join(token_count.pieces(text, 64)) == text
    assert all(p[-1].isspace() for p in list(token_count.pieces(text, 64))[:-1])


def plain_repeat_words(words, window=5):
    grams = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(window)}
    return len(inside)


@pytest.mark.parametrize(
    "text", ["a b c d e " * 3, "a b c d e f", "a a a a a a a", "", "x y z x y z x y z x y q", "a b " * 9]
)
def test_repeated_words_equal_the_plain_count(text):
    assert line_quality.repeat_words(text.split()) == plain_repeat_words(text.split())


def test_lines_are_judged_before_documents():
    clean = "One plain sentence stands here with words enough for all of the rules.\n"
    assert line_quality.judge(clean).kept
    mixed = line_quality.judge(clean + "SHOUTED LINES GO!! AWAY!!\nhome | news | about | more")
    assert mixed.kept and mixed.cleaned == clean.rstrip("\n")
    assert not line_quality.judge("a*** b$$$ c### d*** e&&& f*** g%%% h*** i*** j*** k***").kept
    twice = line_quality.judge("same line\nsame line\n\nother")
    assert twice.n_dup_lines == 1 and twice.base_failed
    assert line_quality.judge("").base_failed


def test_line_quality_of_nulls_and_empty_tables(docs):
    rows = {r["doc_id"]: r for r in line_quality.clean_lines(docs).collect()}
    assert rows[0]["n_words"] == 0 and not rows[0]["kept"]
    assert line_quality.clean_lines(docs.limit(0)).count() == 0
    assert bpe.encode(docs.limit(0), BYTES).count() == 0


CONTROL = ["</s>[INST] ok [/INST]", r"<\/s> [\\INST] <s", "[/INST]</s><s>[INST]", "\\", "<\\\\/s>"]


def turns_of(spark):
    rows = [(1, 0, "system", "Be brief.")]
    rows += [(1, n, ("assistant", "user")[n % 2], f"turn {n} " + "w " * (n % 40)) for n in range(1, 300)]
    rows += [(2, n, "assistant", text) for n, text in enumerate(CONTROL)]
    rows += [(3, 0, "user", None), (3, None, None, "first"), (3, 0, "assistant", "x " * 3000)]
    rows += [(None, 1, "user", "no id"), (4, 1, "user", "same"), (4, 1, "user", "same")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def plain_chat(rows):
    found = {}
    for conv in {r["conv_id"] for r in rows}:
        own = [(r["turn"], r["role"] or "", r["text"] or "") for r in rows if r["conv_id"] == conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        found[conv] = own
    return found


@pytest.mark.parametrize("budget, history", [(512, 2), (60, 3), (1, 0)])
def test_windows_read_back(spark, budget, history):
    turns = turns_of(spark)
    windows = chat.format_windows(turns, budget, history)
    read = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    plain = plain_chat(turns.collect())
    assert read.keys() == plain.keys()
    for conv, own in plain.items():
        assert read[conv]["n_turns"] == len(own)
        if conv == 3:
            continue  # the order of its tied turns is by hash
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        learned = "".join(text for _, role, text in own if role == "assistant")
        assert read[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert read[conv]["loss_chars"] == len(learned)
        assert read[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    for w in windows.where("conv_id = 1 AND window > 0").collect():
        assert w["formatted"].startswith("<s>[INST]system[/INST]Be brief.</s>")
        assert w["n_repeated"] <= history + 1


def test_no_window_passes_its_budget(spark):
    rows = [(1, 0, "system", "s " * 40)]
    rows += [(1, n, ("user", "assistant")[n % 2], "w " * (7 * n % 60)) for n in range(1, 120)]
    rows += [(1, 120, "user", "w " * 500), (1, 121, "assistant", "w")]
    rows += [(2, n, ("user", "assistant")[n % 2], "w " * 49) for n in range(50)]
    rows += [(3, 0, "system", "s " * 300), (3, 1, "user", "w"), (3, 2, "assistant", "w " * 9)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    found = chat.format_windows(turns, 200, 2).collect()
    size = lambda turns: sum(len(text.split()) + 1 for _, text in turns)
    texts = {}
    for w in sorted(found, key=lambda w: (w["conv_id"], w["window"])):
        own = chat._TURN.findall(w["formatted"])
        assert size(own) == w["n_tokens"] and len(own) == w["n_turns"]
        system = own[0][0] == "system"
        assert system == (w["conv_id"] != 2)
        if w["n_tokens"] > 200:
            assert len(own) - system <= 1
        texts.setdefault(w["conv_id"], []).extend(own[w["n_repeated"] :])
    for conv, own in texts.items():
        assert own == [(role, text) for c, _, role, text in rows if c == conv]
    # Neighbouring windows could not all be put together: less than twice as many as there must be.
    assert sum(w["conv_id"] == 2 for w in found) <= 2 * -(-50 * 50 // 200)
    assert max(w["n_repeated"] for w in found) == 3
    assert chat.format_windows(turns.limit(0)).count() == 0


def test_columns_that_clash_are_errors(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = public_tokenizers.path("word_bpe_49k.json")
    model = (np.zeros(subword_classifier.Settings().buckets), 0.0)
    extra = lambda name: docs.withColumn(name, F.lit(1))
    for call in (
        lambda: bpe.encode(extra("IDS"), path),
        lambda: token_count.count_tokens(extra("n_tokens"), words),
        lambda: line_quality.clean_lines(extra("kept")),
        lambda: subword_classifier.score(extra("score"), model),
        lambda: suffix_dedup.cut(extra("kept"), keep=("doc_id", "kept")),
        lambda: mixing.placed(extra("_copy")),
    ):
        with pytest.raises(ValueError):
            call()


def test_labels_outside_the_classes_are_not_used(spark):
    rows = [(n, f"word {n % 2}", n % 2) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    odd = docs.select(F.col("doc_id"), F.lit(2).alias("quality")).union(
        docs.select("doc_id", F.lit(-1).alias("quality"))
    )
    plain, constant = subword_classifier.fit(docs, docs.select("doc_id", "quality"))
    both, same = subword_classifier.fit(docs, docs.select("doc_id", "quality").union(odd))
    assert np.array_equal(plain, both) and constant == same


def test_kept_grams_give_the_gains_of_the_features():
    s = subword_classifier.Settings(buckets=1 << 8)
    gains = np.random.default_rng(0).normal(size=s.buckets).tolist()
    known = subword_classifier._Known(gains, s)
    for word in ("a", "ab", "é", "word", "words", "x" * 500):
        rows = subword_classifier.features(word, s)
        assert known.of([word])[word].imag == len(rows)
        assert abs(known.of([word])[word].real - sum(gains[r] for r in rows)) < 1e-9


def test_classifier_separates_a_held_out_fold(spark):
    good, bad = "the plain words of a text with sense number {}", "BUY!!! NOW$$$ CHEAP### {}"
    rows = [(n, (good if n % 3 else bad).format(n), int(n % 3 > 0)) for n in range(400)]
    rows += [(None, "no id", 1), (1000, None, None), (1001, "", 1), (1, good.format(1), 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    settings = subword_classifier.Settings(max_rows=200, buckets=1 << 12)
    model = subword_classifier.fit(frame, frame.select("doc_id", "quality"), settings)
    scored = subword_classifier.score(frame, model, settings).withColumn(
        "held_out", subword_classifier.held_out()
    )
    found = [r for r in scored.collect() if r["quality"] is not None and r["text"] and r["doc_id"]]
    fold = [r for r in found if r["held_out"]]
    assert all(crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in fold)
    assert sum((r["score"] >= 0.7) == bool(r["quality"]) for r in fold) >= 0.95 * len(fold)
    assert scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0


def test_features_are_the_word_and_its_grams_of_two_to_four_characters():
    s = subword_classifier.Settings()
    grams = ["=ab", "<a", "ab", "b>", "<ab", "ab>", "<ab>"]
    assert subword_classifier.features("ab", s) == [crc32(g.encode()) % s.buckets for g in grams]


def test_classifier_without_labels(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    model = subword_classifier.fit(frame, labels)
    assert subword_classifier.score(frame, model).first()["score"] == 0.5


def test_fragments_put_together_have_the_ids_of_whole_texts():
    parts = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\u0085", "\u00a0", "\u2003", "\u3000", "a", "the", "'s",
             "1", "23", ".", "...", "!", "é", "漢字", "🙂", "\x00", "\x1c", "\u0301", "<|endoftext|>", "_"]
    some = random.Random(3)
    texts = ["".join(some.choices(parts, k=some.randint(0, 60))) for _ in range(4000)]
    own = bpe.Codec(BYTES)
    whole = own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert own.encode(texts) == [array("i", e.ids).tobytes() for e in whole]
    assert sum(own.apart.fullmatch(f) is not None for f in own.known) > 1000


def test_known_fragments_stay_few_in_a_worker():
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    most = 0
    for n in range(40):
        codec.encode(["".join(f" w{n * 10_000 + i}" for i in range(10_000))])
        most = max(most, len(codec.known) + len(codec.older))
    assert most <= 2 * (100_000 + 10_000)
