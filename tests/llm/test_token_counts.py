"""op11 against the library itself."""

import pytest

from farpoint.llm import token_counts as T
from farpoint.llm import words as W
from cases import documents, frame

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))

ODD = [" ", "  ", "\n", "a\n\n b", " lead", "trail  ", "a   b\tc\r\n", "▁", "a▁b ▁ c", "　x y", "0123 45.6e-7", "<s> </s> <unk>",
       "é" * 300, "x" * 70_000, "naïve 🙂🙃 日本語 テキスト", "a\x00b", "\n ", " \n", "word " * 5000, "\x7f\x01"]


def rows():
    out = documents()
    return out + [(10_000 + i, t, "en", "a") for i, t in enumerate(ODD)] + [(None, "no id", "en", "a")] * 2


def expected(data, limit):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = []
    for i, t, *_ in data:
        n = len(sp.encode(t or ""))
        out.append((i, len((t or "").encode()), n, n > limit))
    return sorted(out, key=repr)


@pytest.mark.parametrize("table_rows", [T.TABLE_ROWS, 7, 0])
def test_counts_equal_the_library(spark, table_rows):
    data = rows()
    got = T.count_tokens(frame(spark, data).repartition(3), MODEL, 500, table_rows).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(data, 500)


def test_full_cache_and_summary(spark, monkeypatch):
    monkeypatch.setattr(T, "CACHE_ROWS", 20)
    monkeypatch.setattr(T, "SUMMARY_ROWS", 16)
    monkeypatch.setattr(T, "TASK_ROWS", 5)
    data = rows()
    got = T.count_tokens(frame(spark, data), MODEL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(data, 4096)


def test_a_model_without_cuts_takes_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(T, "cut_rules", lambda model: T.CutRules(None))
    data = [r for r in rows() if len(r[1] or "") < 5000]
    got = T.count_tokens(frame(spark, data), MODEL).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(data, 4096)


def test_empty_table(spark):
    assert T.count_tokens(frame(spark, []), MODEL).collect() == []


def test_pre_tokens_cover_the_text():
    import pyarrow as pa
    rules = T.cut_rules(open(MODEL, "rb").read())
    assert rules.solo is not None
    for c in W.chunks(T.spaced(pa.array(ODD + [None, ""]))):
        start, end, first = T.pre_tokens(c, rules)
        assert (end[:-1] == start[1:]).all() and start[0] == 0 and end[-1] == len(c.buf)
        assert first[-1] == len(start) and first[-1] == first[-2] == first[-3]


def test_length_table():
    import numpy as np
    h = W.mix(np.arange(1, 5001, dtype=np.uint64)) & np.uint64(0xFFF0000000000FFF)    # crowded slots
    h = np.unique(h)
    t = T.LengthTable.build(h, (np.arange(len(h)) % 900).astype(np.uint16))
    assert (t.find(h) == np.arange(len(h)) % 900).all()
    assert (t.find(h + np.uint64(1 << 40)) == -1).all()
