"""Full pieces and the open bins."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm.packing import BestFit, pack


def test_full_pieces_close_no_bin():
    packer = BestFit(10, 2)
    assert [packer.place(n) for n in (6, 7, 10, 10, 3, 4)] == [(0, 0), (1, 0), (2, 0), (3, 0), (1, 7), (0, 6)]
    assert packer.open == 0


def test_full_pieces_cost_their_own_sequences_only():
    packer = BestFit(2048, 64)
    for n in 10 * (64 * [1500] + 60 * [2048] + 64 * [548]):
        packer.place(n)
    assert packer.opened == 10 * (64 + 60)


def test_very_long_runs_have_the_named_tokenizers_ids(spark):
    named = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" * 50_000, "x" + " " * 1_200_000 + "y", "plain words", None]
    rows = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        ids = np.array([*named.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
