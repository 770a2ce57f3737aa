import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import preference, sft, tokens


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(0, "a b a c"), (1, "  b\ta\n\na zz "), (2, ""), (3, None), (4, "naïve 日本 a")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.fixture(scope="module")
def vocab(docs):
    return tokens.build_vocab(docs, 7)


def ids(df, column="ids"):
    return {r.doc_id: r[column] for r in df.collect()}


def test_vocabulary_by_count_then_token(vocab):
    got = {r.token: (r.n, r.id) for r in vocab.collect()}
    assert got == {"<unk>": (0, 0), "<s>": (0, 1), "</s>": (0, 2), "<pad>": (0, 3), "a": (5, 4), "b": (2, 5), "c": (1, 6)}
    row = tokens.vocab_size(vocab).collect()[0]
    assert (row.vocab_size, row.bos_id, row.eos_id, row.pad_id) == (7, 1, 2, 3)


def test_pad_falls_back_to_the_end_token(docs):
    row = tokens.vocab_size(tokens.build_vocab(docs, 7, with_pad=False)).collect()[0]
    assert row.pad_id == row.eos_id == 2
    with pytest.raises(ValueError):
        tokens.build_vocab(docs, 4)


def test_encode(docs, vocab):
    assert ids(tokens.encode(docs, vocab)) == {0: [4, 5, 4, 6], 1: [5, 4, 4, 0], 2: [], 3: [], 4: [0, 0, 4]}
    framed = ids(tokens.encode(docs, vocab, max_length=4, add_bos=True, add_eos=True))
    assert framed[0] == [1, 4, 5, 4] and framed[2] == [1, 2]


def test_encode_stays_in_the_scan_stage(docs, vocab):
    plan = tokens.encode(docs, vocab).select("ids")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery subquery")[0]
    assert "Exchange" not in main and "Join" not in main and "Python" not in plan
    # The lookup is part of the expression, not a column copied into every row.
    assert "AS _slots" not in plan


def test_pad_and_decode(docs, vocab):
    full = tokens.pad(tokens.encode(docs, vocab), 3)
    got = {r.doc_id: (r.input_ids, r.attention_mask) for r in full.collect()}
    assert got[0] == ([4, 5, 4], [1, 1, 1]) and got[4] == ([0, 0, 4], [1, 1, 1]) and got[2] == ([3, 3, 3], [0, 0, 0])
    assert ids(tokens.decode(tokens.encode(docs, vocab), vocab), "text")[1] == "b a a"
    assert ids(tokens.decode(tokens.encode(docs, vocab), vocab, skip_special=False), "text")[1] == "b a a <unk>"


def test_whitespace_counts(spark):
    rows = [("Hello, world! This is a test of the tokenizer.", 9), ("Hello, world! This is a test.", 6), ("", 0), (None, 0)]
    df = spark.createDataFrame(rows, "text string, n int")
    assert all(r.n == r.c for r in df.withColumn("c", tx.word_count(F.col("text"))).collect())


def test_chat_formats(spark):
    nested = spark.createDataFrame(
        [([("user", "hi"), ("assistant", "yo")],), ([(None, None)],)], "messages array<struct<role:string,content:string>>"
    )
    assert [r.text for r in sft.format_examples(nested).collect()] == ["<|user|>\nhi\n<|assistant|>\nyo\n", "<|user|>\n\n"]
    turns = spark.createDataFrame([(1, 1, "assistant", "yo"), (1, 0, "user", "hi")], "conv_id int, turn int, role string, text string")
    assert sft.chat_template(turns).collect()[0].text == "<|user|>\nhi\n<|assistant|>\nyo\n"
    pair = spark.createDataFrame([("do", "done")], "instruction string, response string")
    assert sft.format_examples(pair).collect()[0].text == "### Instruction:\ndo\n\n### Response:\ndone"
    other = spark.createDataFrame([(7, "x")], "id int, body string")
    assert sft.format_examples(other).collect()[0].text == "7"
    assert sft.format_examples(other.withColumn("text", F.lit("t"))).collect()[0].text == "t"


@pytest.mark.parametrize("parts", [1, 6])
def test_chats_from_turns_equal_chats_from_texts(spark, parts):
    rows = [(c, t, "user" if t % 2 else "assistant", "a b " * (t * c % 7)) for c in range(6) for t in range(c * 5)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    chats = sft.chat_template(turns)
    vocab = tokens.build_vocab(chats, 50)
    want = {r.conv_id: (r.input_ids, r.attention_mask, r.labels) for r in sft.prepare(chats, vocab, 12).collect()}
    got = {
        r.conv_id: (r.input_ids, r.attention_mask, r.labels)
        for r in sft.prepare_chats(turns, vocab, 12, parts=parts).collect()
    }
    assert got == want and len(got) == 5


def test_labels_follow_the_mask_not_the_id(spark):
    df = spark.createDataFrame([([5, 2, 2, 2], [1, 1, 0, 0])], "input_ids array<int>, attention_mask array<int>")
    assert sft.mask_labels(df).collect()[0].labels == [5, 2, -100, -100]


def test_step_budget(spark):
    row = sft.step_budget(spark.range(101), batch_size=16, epochs=3, accum=4, warmup_ratio=0.3).collect()[0]
    assert (row.examples, row.batches, row.total_steps, row.warmup_steps) == (101, 7, 5, 1)


def test_pair_formats(spark):
    plain = spark.createDataFrame([("p", "c", "r")], "prompt string, chosen_response string, rejected_response string")
    row = preference.format_pairs(plain).collect()[0]
    assert (row.chosen, row.rejected) == ("pc", "pr")
    assert preference.format_pairs(plain.drop("prompt")).collect()[0].chosen == "c"
    chat = spark.createDataFrame(
        [([("user", "q"), ("assistant", "a")], [("user", "q")])],
        "chosen array<struct<role:string,content:string>>, rejected array<struct<role:string,content:string>>",
    )
    row = preference.format_pairs(chat).collect()[0]
    assert (row.chosen, row.rejected) == ("q a", "q")
    with pytest.raises(ValueError, match="prompt"):
        preference.format_pairs(plain.select("prompt"))


@pytest.mark.parametrize("kind,smoothing,loss", [("sigmoid", 0.0, 0.620957), ("sigmoid", 0.1, 0.635957), ("hinge", 0.0, 0.85)])
def test_preference_loss(spark, kind, smoothing, loss):
    policy = spark.createDataFrame([(1, -10.0, -11.0), (2, -10.0, -11.0)], "pair_id int, policy_chosen double, policy_rejected double")
    ref = spark.createDataFrame([(1, -12.0, -11.5)], "pair_id int, ref_chosen double, ref_rejected double")
    rows = {r.pair_id: r for r in preference.preference_loss(preference.join_reference(policy, ref), 0.1, smoothing, kind).collect()}
    assert rows[1].loss == pytest.approx(loss, abs=1e-6)
    assert (rows[1].chosen_reward, rows[1].rejected_reward) == (pytest.approx(0.2), pytest.approx(0.05))
    assert rows[1].reward_margin == pytest.approx(0.15) and rows[1].reward_accuracy == 1.0
    assert rows[2].chosen_reward == pytest.approx(-1.0)
    free = preference.preference_loss(preference.join_reference(policy, None), 0.1, smoothing, kind).collect()[0]
    assert free.chosen_reward == pytest.approx(-1.0)
    with pytest.raises(ValueError):
        preference.preference_loss(preference.join_reference(policy, None), loss_type="other")


def test_loss_does_not_overflow(spark):
    df = spark.createDataFrame([(1000.0,), (-1000.0,), (0.0,)], "x double").select(preference.neg_log_sigmoid(F.col("x")).alias("y"))
    assert [r.y for r in df.collect()] == [pytest.approx(0.0), pytest.approx(1000.0), pytest.approx(0.693147, abs=1e-6)]


def test_sequence_logp(spark):
    rows = [(1, 0, 5, -9.0), (1, 1, 6, -1.0), (1, 2, -100, -2.0), (1, 3, 100, -4.0), (1, 4, 3, -8.0)]
    df = spark.createDataFrame(rows, "seq_id int, pos int, label int, logp double")
    assert preference.sequence_logp(df, 100).collect()[0].logp == -9.0
    assert preference.sequence_logp(df, 100, exclude_padding=True).collect()[0].logp == -1.0


def test_decode_without_pad_and_unknown_ids(spark):
    docs = spark.createDataFrame([(1, "a a a b b c")], "doc_id long, text string")
    vocab = tokens.build_vocab(docs, 10, with_pad=False)
    coded = tokens.encode(docs, vocab)
    assert tokens.decode(coded, vocab).first().text == "a a a b b c"
    odd = spark.createDataFrame([([4, 99, 5],)], "ids array<int>")
    assert tokens.decode(odd, vocab).first().text == "a <unk> b"


def test_a_vocabulary_beyond_its_bounds_is_refused(spark):
    docs = spark.createDataFrame([(1, "a a a b b c")], "doc_id long, text string")
    vocab = tokens.build_vocab(docs, 7)
    assert tokens.encode(docs, vocab, max_entries=7).first().ids == [4, 4, 4, 5, 5, 6]
    for bound in ({"max_entries": 6}, {"max_bytes": 10}):
        with pytest.raises(ValueError):
            tokens.encode(docs, vocab, **bound)


def test_any_vocabulary_gives_what_a_carried_one_gives(spark, monkeypatch):
    rows = [(i, f"a b{i % 7} c{i % 50}  d{i}\ta") for i in range(300)]
    rows += [(300, ""), (301, None), (302, " \n "), (303, "a " * 5000 + "zz"), (None, "a b1"), (300, "twice"), (304, "<pad> <unk> a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_row": F.lit(1), "token": F.lit("x"), "id": F.lit(2)})
    vocab = tokens.build_vocab(docs, 60)
    # Slices of a few rows.
    monkeypatch.setattr(tokens, "SLICE_BYTES", 400)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, str(r.text))
    for options in ({}, {"max_length": 3}, {"max_length": 2, "add_bos": True}, {"add_bos": True, "add_eos": True}):
        want = sorted(tokens.encode(docs, vocab, **options).collect(), key=key)
        assert sorted(tokens.encode_any(docs, vocab, "doc_id", **options).select(*want[0].__fields__).collect(), key=key) == want
    coded = tokens.encode(docs.select("doc_id", "text"), vocab, add_eos=True).drop("text")
    coded = coded.unionByName(spark.createDataFrame([(900, [4, 99999, 5]), (901, []), (902, None)], "doc_id long, ids array<int>"))
    for skip in (True, False):
        want = sorted(tokens.decode(coded, vocab, skip).collect(), key=key)
        got = sorted(tokens.decode_any(coded, vocab, "doc_id", skip).select(*want[0].__fields__).collect(), key=key)
        assert got == want
    assert tokens.encode_any(docs.limit(0), vocab, "doc_id").collect() == []
    assert tokens.decode_any(coded.limit(0), vocab, "doc_id").collect() == []
