"""Ids of word pieces against the library's own on whole texts."""

import gc
import io
import random

import numpy as np
import pyarrow as pa

from lakeloom.llm import token_files
from lakeloom.llm.common import BATCH_CONF, pieces, small_batches
from lakeloom.llm.queries import word_vocabulary

ODD = [
    "",
    " ",
    "Don't STOP!! a.b,c Hello,world! x's 's 'S it'LL, end.'s É. İ I K K. 12. a1. .,; ABC",
    "<|endoftext|>. <|ENDOFTEXT|> a<|startoftext|>b, C.",
    "a\x0bb\x1cc \x00 \x85 x　y",
    "straße ÀÉÎ àéî ñandú naïve ÿ ÷ × µ º ª ﬁ Å, école",
    "x" * 5000 + "." * 300,
]


def test_ids_are_those_of_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    marks = ["a", "B", "ß", "ñ", "Ñ", "ǆ", "é", "ſ", "'s", ".", ",", " ", "É", "1", "!", "'", "\n", "K", "İ", "<|", "́"]
    texts = [*ODD, *("".join(rng.choice(marks) for _ in range(300)) for _ in range(60))]
    path = word_vocabulary()
    library = Tokenizer.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids + [7] for t in texts]
    for kept in (token_files.CACHED_WORDS, 3):
        monkeypatch.setattr(token_files, "CACHED_WORDS", kept)
        encode = token_files.encoder(path, 7)
        got = []
        for at in range(0, len(texts), 9):
            ids, lengths = encode([t.encode() for t in texts[at : at + 9]])
            got += [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])]
        assert got == want


def test_plain_letters_are_letters_the_normalizer_leaves():
    import unicodedata

    for c in token_files.PLAIN_LETTERS:
        assert token_files.PLAIN.fullmatch(c.encode()) and c.lower() == c == unicodedata.normalize("NFC", c)
        assert unicodedata.category(c) == "Ll"
    assert not any(token_files.PLAIN.fullmatch(c.encode()) for c in "A1.÷×É'_́ł")


def test_a_writer_keeps_no_texts(tmp_path):
    """Of a batch that was sent, a file under way keeps the ids and lengths, not the texts."""
    sent = io.BytesIO()
    rows = pa.record_batch({"doc_id": pa.array([1, None, 3]), "text": [b"a" * 100_000, b"", b"b c"]})
    with pa.ipc.new_stream(sent, rows.schema) as out:
        out.write_batch(rows)
    received = bytearray(sent.getvalue())
    writer = token_files.Writer(f"file:{tmp_path}/x.tokens", 16)
    encode = token_files.encoder(word_vocabulary(), 7)
    for batch in pieces(pa.ipc.open_stream(pa.py_buffer(received)), size=10):
        ids, lengths = encode(batch.column("text").to_pylist())
        writer.add(batch.column("doc_id"), lengths, ids)
    del batch
    gc.collect()
    received.clear()  # fails while anything refers to the batch
    writer.close()
    reader = token_files.Reader(f"file:{tmp_path}/x.tokens")
    assert reader.doc_ids.to_pylist() == [1, None, 3]
    assert reader.document(1).tolist() == [7]


def test_texts_are_sent_in_small_batches(spark, tmp_path, monkeypatch):
    """Files are written from batches of a few MiB; the session's own size stays, and so does an unset one."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    def written(df, label):
        seen.append(max(r.n for r in texts.mapInArrow(sizes, "n bigint").collect()))
        return pin(df, label)

    seen, pin = [], token_files.pin
    texts = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('ab ', 1000) AS text")
    monkeypatch.setattr(token_files, "pin", written)
    got = token_files.packed(texts, word_vocabulary(), folder=f"file:{tmp_path}/a")
    assert sorted(r.n_tokens for r in got.collect()) == [1001] * 4000
    assert spark.conf.get(BATCH_CONF, None) is None
    spark.conf.set(BATCH_CONF, 64 << 20)
    try:
        with small_batches(spark, 1 << 20):
            assert spark.conf.get(BATCH_CONF) == str(64 << 20)
    finally:
        spark.conf.unset(BATCH_CONF)
    assert seen[0] < 2 * token_files.PIECE_BYTES + (1 << 20)
