"""Packing and token counts against the library; unit cutting on random text."""

import random
import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from isobar.llm.packing import encode_texts, pack
from isobar.llm.pretokens import UnitEncoder
from isobar.llm.queries import op5_packing
from isobar.llm.token_counts import token_counts
from tests.llm.conftest import odd_rows

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORDS, BYTES], ids=["words", "bytes"])
def test_units_give_the_ids_of_whole_texts(path):
    pick = random.Random(4)
    letters = "aab zZ09'’.,!  \n\t éÉßİıſ×÷жЖ中文 ́ñ<|endoftext|>'s're don't I'LL ½²٣　   x\x1c\u0085"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(60))) for _ in range(6000)]
    texts += ["", None, "<|endoftext|>", "a <|endoftext|> b<|startoftext|>c", "\n\n a", "a \n\nb"]
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        encoder = UnitEncoder(file.read(), 1000)
    found = encode_texts(pa.array(texts), encoder)
    for text, ids in zip(texts, found, strict=True):
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == wanted, text


@pytest.mark.parametrize("frequent", [0, 40, 65_536])
def test_counts_are_the_librarys(odd, frequent):
    library = Tokenizer.from_file(BYTES)
    found = token_counts(odd, BYTES, frequent=frequent).collect()
    wanted = sorted((len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in (r[1] or "" for r in odd_rows()))
    assert sorted((row.n_bytes, row.n_tokens) for row in found) == wanted
    assert all(row.over_limit == (row.n_tokens > 1024) for row in found)


def test_packing_is_gapless_and_whole(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library = Tokenizer.from_file(WORDS)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs.items()}
    pieces = op5_packing(spark, sf_dir).collect()
    seen, sequences = {}, {}
    for piece in pieces:
        part = ids[piece.doc_id][piece.start : piece.start + piece.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == piece.ids_crc32
        assert piece.doc_tokens == len(ids[piece.doc_id])
        seen.setdefault(piece.doc_id, []).append((piece.start, piece.length))
        sequences.setdefault(piece.sequence_id, []).append((piece.offset, piece.length))
    for spans, total in [(sorted(seen[i]), len(ids[i])) for i in ids]:
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) == total
    for number, spans in sequences.items():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) == 2048 or number == max(sequences)


def test_packing_odd_rows(odd):
    pieces = pack(odd, WORDS, length=64)
    total = pieces.agg(F.sum("length"), F.countDistinct("sequence_id"), F.max("sequence_id")).first()
    library = Tokenizer.from_file(WORDS)
    wanted = sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows())
    assert total[0] == wanted and total[1] == total[2] + 1 == -(-wanted // 64)
    assert pieces.where("doc_id is null").count() >= 2


def test_empty_tables(nothing):
    assert pack(nothing, WORDS).count() == token_counts(nothing, BYTES).count() == 0
