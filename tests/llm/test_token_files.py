import random
import zlib

import numpy as np
import pytest
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from tokenizers import Tokenizer

from lexmill.llm import queries, token_files, tokens
from lexmill.session import scratch_path

PATHS = {"kept": tokens.vocabulary_path("byte_bpe_50k.json"), "dropped": tokens.vocabulary_path("word_bpe_49k.json")}


def library_ids(text, blanks="kept"):
    library = Tokenizer.from_file(PATHS[blanks])
    return library.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    found, before = [], 0
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")
    for row in sorted(rows, key=key):
        ids = library_ids(row["text"]) + [2]
        found.append((row["doc_id"], before, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        before += len(ids)
    return found


def in_order(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[1])


def test_query_round_trip(spark):
    rows = queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    assert in_order(queries.op2_token_files(spark, SF_DIR)) == expected(rows)


def test_odd_documents(spark, odd_documents, no_documents):
    path = scratch_path(spark, "odd")
    token_files.write_tokens(odd_documents, path, PATHS["kept"])
    assert in_order(token_files.read_tokens(spark, path)) == expected(odd_documents.collect())
    path = scratch_path(spark, "none")
    token_files.write_tokens(no_documents, path, PATHS["kept"])
    assert token_files.read_tokens(spark, path).count() == 0


@pytest.mark.parametrize("blanks", ["kept", "dropped"])
def test_ids_are_those_of_the_library(blanks):
    encoder = tokens.Encoder(PATHS[blanks], blanks)
    library = Tokenizer.from_file(PATHS[blanks])
    random.seed(1)
    bits = [" ", " ", "\n", "\t", "a", "Word", "ÉÀ", "ß", "µ", ".", ",", "12", '"', "Σ", "́", "\x1c", "　", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "'s", "本", "İ", "\r\n"]
    for _ in range(3000):
        text = "".join(random.choices(bits, k=random.randrange(12)))
        ids = np.frombuffer(encoder.ids(text), encoder.dtype).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_boundaries():
    random.seed(2)
    for _ in range(200):
        lengths = [random.randrange(1, random.choice([2, 5, 3000])) for _ in range(random.randrange(1, 300))]
        ends = np.cumsum(lengths)
        coded = token_files.Boundaries.of(ends)
        assert coded.all().tolist() == ends.tolist()
        assert [coded.boundary(i) for i in range(len(ends))] == ends.tolist()
        assert 8 * (len(coded.low) + len(coded.high)) <= len(ends) * (2 + np.log2(max(ends[-1] / len(ends), 1)) + 1) + 16


def test_block_finds_each_document():
    parts = [np.arange(n, dtype="<u2") for n in (1, 5, 3, 700, 2)]
    block = token_files.Block(token_files.pack_block([4, None, 6, 6, 9], [len(p) for p in parts], b"".join(p.tobytes() for p in parts), 2))
    assert [block.ids(i).tolist() for i in range(5)] == [p.tolist() for p in parts]
    with pytest.raises(ValueError):
        token_files.Block(b"nope" + bytes(40))
