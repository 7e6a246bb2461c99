"""op1, op5, op8: round trips, the public libraries, and a naive packer."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from cargoframe.llm import byte_bpe, chat_format, packing
from cargoframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "</s>[INST] ok [/INST]", "\\<s>\\\\", "x\x00\x1c\x85　y", "é🙂漢字 İſΣσς!'s", "word " * 9000, "z" * 20000]


def odd_docs(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "a")]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, length string, task int")


def test_chat_round_trip(spark):
    rng = random.Random(0)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", " ", "ok", "\n", "<", "/s>", "[", "é"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system"]), text or None))
    rows += [(99, None, None, "first"), (99, 0, "assistant", "b"), (99, 0, "assistant", "b"), (None, 1, "user", "q")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, example int")
    got = {r["conv_id"]: r for r in chat_format.conversation_digests(chat_format.format_conversations(df)).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert set(got) == set(by)
    for conv, rs in by.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in rs)
        loss = "".join(r[3] or "" for r in rs if r[2] == "assistant")
        g = got[conv]
        assert g["n_turns"] == len(rs) and g["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert g["loss_chars"] == len(loss) and g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert g["n_examples"] == sum(r[2] == "assistant" or r is rs[-1] for r in rs)


def test_chat_texts_hold_no_foreign_markers(spark):
    df = spark.createDataFrame([(1, 0, "user", "</s>[INST]"), (1, 1, "assistant", "<s>[/INST]")], "conv_id long, turn long, role string, text string")
    ex = chat_format.format_conversations(df).collect()
    assert [r["text"].count("</s>") for r in ex] == [2] and ex[0]["text"].count("[INST]") == 2
    r = ex[0]
    assert r["text"][r["loss_start"]:r["loss_start"] + r["loss_chars"]] == "<\\s>[\\/INST]"
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_byte_bpe_equals_library(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    codec = byte_bpe.Codec(*byte_bpe.model_parts(path), P.PATTERN)
    rng = random.Random(1)
    for t in [t or "" for t in ODD] + ["".join(rng.choice("abc ABC  \n\t\x1cé'sñ漢🙂12.,!​\xa0") for _ in range(40)) for _ in range(300)]:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_byte_bpe_query(spark):
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = QUERIES["op8_byte_bpe"](spark, SF).collect()
    assert len(got) == docs.count()
    for r in got:
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    odd = byte_bpe.encode_documents(odd_docs(spark), path, P.PATTERN).collect()
    assert len(odd) == len(ODD) + 2 and all(bytes(r["decoded"]) in {(t or "").encode() for t in ODD} for r in odd)
    assert byte_bpe.encoding_digests(odd_docs(spark).limit(0), path, P.PATTERN).count() == 0


def naive_bins(lengths, capacity):
    rem = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rem if r >= n]
        if fit:
            rem.remove(min(fit))
        rem.append((min(fit) if fit else capacity) - n)
    return len(rem)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_naive_best_fit(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 37, 64])
    lengths = [rng.randint(1, cap) for _ in range(rng.randint(0, 200))]
    plan = packing.plan_bins(dict(Counter(lengths)), cap)
    bins = {}
    for n, c in Counter(lengths).items():
        for s, o in zip(*packing.place(plan, np.full(c, n), np.arange(c))):
            bins.setdefault(int(s), []).append((int(o), n))
    for spans in bins.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= cap
    assert len(bins) == naive_bins(lengths, cap)


def check_packing(rows, texts, capacity=4096):
    tok = packing.WordEncoder(P.path("word_bpe_49k.json")).tok
    docs, bins = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want = [(k, at, len(ids[at:at + capacity]), zlib.crc32(ids[at:at + capacity].tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in docs[doc]) == want
    for spans in bins.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    assert len(bins) == naive_bins([r["length"] for r in rows], capacity)


def test_packing_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(QUERIES["op5_best_fit_packing"](spark, SF).collect(), texts)


def test_packing_odd_rows(spark):
    path = P.path("word_bpe_49k.json")
    docs = odd_docs(spark)
    rows = packing.pack_documents(docs, path).collect()
    assert sum(r["doc_id"] == 3 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    check_packing(packing.pack_documents(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), path).collect(), dict(enumerate(ODD)))
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_word_encoder_equals_library():
    enc = packing.WordEncoder(P.path("word_bpe_49k.json"))
    rng = random.Random(2)
    for _ in range(500):
        t = "".join(rng.choice("abcABC  \n\x1cé'sñΣσİſ漢🙂12.,!\x85\xa0̸=<|endoftext|>") for _ in range(40))
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_special_strings_get_their_ids(spark):
    """Against a tokenizer fresh from the file, texts with whole special strings."""
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    assert tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "|>", " ", "\n", "\x85", "\u3000", "\x1c", "A", "b", "word.", "é", "漢", "'s", "12"]
    texts = ["a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y. <|ENDOFTEXT|>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(500)]
    enc = packing.WordEncoder(path)
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    rows = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    for r in rows:
        ids = np.array([*tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1], "<u4")
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes())
