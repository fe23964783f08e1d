"""Token output and packing: exact round trips against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.helpers import ODD, documents, empty, odd
from tracewright.llm import packing, token_output
from tracewright.llm.common import table
from tracewright.llm.queries import QUERIES
from tracewright.llm.tokenizing import encoder, tokenizer_path

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


LIBRARY = {name: Tokenizer.from_file(tokenizer_path(name)) for name in (BYTE, WORD)}


def library_ids(name, text):
    """From the library as it is loaded."""
    return LIBRARY[name].encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(text=st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", *" \n\t\r\x0b\x1c\x85 　abzABZ019.,!?'’-_()#éÉßñ×ªµʼΣςİı中́\U0001f600<|>"]), max_size=60).map("".join))
def test_pieces_encode_as_the_whole_text(name, text):
    enc = encoder(tokenizer_path(name))
    assert np.frombuffer(enc.encode([text])[0], enc.dtype).tolist() == LIBRARY[name].encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200), st.integers(0, 32))
def test_values_survive_packing(values, shift):
    v = (np.array(values, np.uint64) >> np.uint64(shift)).astype(np.uint32)
    control, data = token_output.pack_values(v)
    assert (token_output.unpack_values(control, data, len(v)) == v).all()
    assert len(control) == -(-len(v) // 4) and len(data) == sum(1 + (x > 0xFF) + (x > 0xFFFF) + (x > 0xFFFFFF) for x in v.tolist())


def test_shards_hold_all_ids_in_order_of_doc_id(spark):
    got = [tuple(r) for r in token_output.digests(*token_output.write_shards(odd(spark), tokenizer_path(BYTE))).orderBy("start").collect()]
    want, start = [], 0
    for doc_id, text, *_ in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library_ids(BYTE, text)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want


def test_no_documents_no_shards(spark):
    assert token_output.read_shards(*token_output.write_shards(empty(spark), tokenizer_path(BYTE))).count() == 0
    assert packing.pack(empty(spark), tokenizer_path(WORD)).count() == 0


def check_packing(pieces, wanted):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        assert len(p["ids"]) == 4 * p["length"]
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        sizes = [p["length"] for p in parts]
        assert [p["offset"] for p in parts] == [sum(sizes[:i]) for i in range(len(sizes))]
        assert sum(sizes) <= 4096 and sum(sizes).bit_count() == 1
    seen = sorted((str(d), b"".join(p["ids"] for p in sorted(parts, key=lambda p: (p["start"], p["sequence_id"])))) for (d, _), parts in by_doc.items())
    return seen == sorted(wanted)


def test_every_id_lies_in_one_piece_and_sequences_are_full(spark):
    docs = [(i, " ".join(["alpha beta gamma"] * (i * i % 700))) for i in range(60)] + [(100, None), (101, ""), (None, "odd one"), (102, "tail " * 9000)]
    pieces = packing.pack(documents(spark, docs).coalesce(1), tokenizer_path(WORD)).collect()
    assert check_packing(pieces, [(str(d), np.array(library_ids(WORD, t), "<u4").tobytes()) for d, t in docs])
    tokens = {}
    for p in pieces:
        tokens[p["step_group"]] = tokens.get(p["step_group"], 0) + p["length"]
    assert max(tokens.values()) <= packing.STEP_SEQUENCES * 4096


def test_step_groups_have_equal_numbers_of_tokens(spark):
    rng = np.random.default_rng(0)
    docs = [(i, "alpha " * int(rng.choice([3, 40, 300, 700, 1500, 5000]))) for i in range(900)]
    pieces = packing.pack(documents(spark, docs).coalesce(1), tokenizer_path(WORD), step_sequences=8).collect()
    assert check_packing(pieces, [(str(d), np.array(library_ids(WORD, t), "<u4").tobytes()) for d, t in docs])
    tokens = {}
    for p in pieces:
        tokens[p["step_group"]] = tokens.get(p["step_group"], 0) + p["length"]
    sizes = sorted(tokens.values())
    assert set(sizes[1:]) == {8 * 4096} and sizes[0] <= 8 * 4096 and len(sizes) > 20


def test_queries_agree_with_the_library(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op5_token_output"](spark, sf).collect()}
    assert got == {d: (len(ids), crc(ids)) for d, t in texts.items() for ids in [library_ids(BYTE, t)]}
    check_pieces(QUERIES["op9_packing"](spark, sf).collect(), {d: library_ids(WORD, t) for d, t in texts.items()})


def check_pieces(pieces, ids):
    """Rows of the packing query against the ids of every document, by doc_id."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert by_doc.keys() == ids.keys()
    for doc_id, parts in by_doc.items():
        parts.sort(key=lambda r: r["start"])
        ends = np.cumsum([r["length"] for r in parts]).tolist()
        assert [r["start"] for r in parts] == [0, *ends[:-1]] and ends[-1] == len(ids[doc_id])
        assert all(r["ids_crc32"] == crc(ids[doc_id][r["start"] : r["start"] + r["length"]]) and r["doc_tokens"] == len(ids[doc_id]) for r in parts)
    for parts in by_sequence.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts]).tolist()
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= 4096 and ends[-1].bit_count() == 1
