"""Token files: exact round trips against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmill.llm.token_files import (
    BLOCK, TokenFile, _files, file_bytes, pack, read_digests, read_files, unpack, write_token_files,
)

SCHEMA = "doc_id long, text string, n long, ids string, place int, start long"


def odd_rows():
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdé ", k=draw.randint(1, 9))) for _ in range(400)]
    texts = [None, "", "\n \t", "<|endoftext|> twice <|endoftext|>", "日本語 𝒳 ﷺ", "a" * 30_000, " ".join(draw.choices(words, k=60_000))]
    texts += [" ".join(draw.choices(words, k=draw.randint(1, 300))) for _ in range(150)]
    rows = [([None, 2**63 - 1, -5, 2**62, -(2**63)][i] if i < 5 else draw.randint(0, 60), t) for i, t in enumerate(texts)]
    return rows + rows[3:9] + [(7, "the same")] * 40 + [(None, "no id")] * 9


def expected(rows):
    encoder = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return [(d, [*encoder.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]


@pytest.mark.parametrize("file_ids, part_bytes", [(1 << 22, 1 << 24), (700, 15_000)])
def test_round_trip(spark, tmp_path, file_ids, part_bytes):
    rows = odd_rows()
    documents = spark.createDataFrame([(d, t, 1, "x", 2, 3) for d, t in rows], SCHEMA).repartition(3)
    path = str(tmp_path / "files")
    write_token_files(documents, path, file_ids=file_ids, part_bytes=part_bytes)
    got = sorted((r.start, r.doc_id, r.n_tokens, list(r.ids)) for r in read_files(spark, path).collect())
    known = expected(rows)
    assert sorted((d is None, d or 0, ids) for _, d, _, ids in got) == sorted((d is None, d or 0, ids) for d, ids in known)
    at = 0
    for start, _, n, ids in got:
        assert (start, n) == (at, len(ids))
        at += n
    order = [(d is None, d or 0) for _, d, _, _ in got]
    assert order == sorted(order)
    digests = sorted((r.start, r.n_tokens, r.ids_crc32) for r in read_digests(spark, path).collect())
    assert digests == [(s, n, zlib.crc32(np.array(ids, "<u4").tobytes())) for s, _, n, ids in got]
    if file_ids == 700:
        assert _files(spark, path).count() > 20


def test_nothing(spark, tmp_path):
    write_token_files(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert read_digests(spark, str(tmp_path / "none")).collect() == []
    write_token_files(spark.createDataFrame([(None, None, None, None, None, None)], SCHEMA), str(tmp_path / "null"))
    assert [tuple(r) for r in read_files(spark, str(tmp_path / "null")).collect()] == [(None, 0, 1, [2])]


@pytest.mark.parametrize("seed", range(6))
def test_blocks(seed):
    draw = np.random.default_rng(seed)
    makes = [
        lambda n: draw.integers(0, 2**32, n), lambda n: draw.zipf(1.3, n).clip(0, 50256), lambda n: np.full(n, 2**32 - 1),
        lambda n: np.where(draw.random(n) < 0.03, 2**32 - 1, 5), lambda n: draw.integers(70_000, 70_003, n), lambda n: np.where(draw.random(n) < 0.1, 3000, draw.integers(0, 9, n)),
    ]
    for n in (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 10 * BLOCK + 17):
        ids = np.concatenate([make(n) for make in draw.permutation(makes)]).astype(np.uint32)
        table, data = pack(ids)
        assert (unpack(table, np.frombuffer(data, np.uint8))[: len(ids)] == ids).all()


def test_files_read_in_part_and_tell_damage():
    draw = np.random.default_rng(1)
    texts = [(i, draw.zipf(1.4, n).clip(0, 50256).astype(np.uint32)) for i, n in enumerate((1, 500, 3, 4000))]
    content = file_bytes(3, 77, texts) + b"\n"
    ids = np.concatenate([x for _, x in texts])
    file = TokenFile(content)
    assert (file.part, file.first, file.ids) == (3, 77, len(ids))
    for start, end in ((0, 0), (0, 1), (255, 257), (256, 512), (1000, 4504), (4503, 4504)):
        assert (file.read(start, end) == ids[start:end]).all()
    # Frequent small ids with rare large ones take fewer bits than the largest id's.
    assert len(file.data) < 1.9 * len(ids)
    with pytest.raises(ValueError):
        TokenFile(content[:200] + bytes([content[200] ^ 1]) + content[201:])
