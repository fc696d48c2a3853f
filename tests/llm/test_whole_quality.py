"""Quality measures of texts that end in blank lines."""

import pyarrow as pa
import pytest

from farpoint.llm import quality
from farpoint.llm import words as W
from test_rows import base_metrics


@pytest.mark.parametrize("texts", [
    ["\n"], ["a\n\n"], ["x y", "a\n\n"], ["a\n", "\n", ""], [" \n\n\n", None], ["a b\na b\n \n\n", "\n"],
    ["a\n  \na\n\n\ta\n\t\na", "b"], ["a\n \n", "a\n\n"], ["", "\n\n", "a\n\n\na\n"]])
def test_texts_that_end_in_blank_lines(texts):
    parts = [quality.chunk_metrics(c) for c in W.chunks(pa.array(texts, pa.string()))]
    (m,) = parts
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]
    got = dict(zip(names, m))
    assert [tuple(int(got[k][i]) for k in names if k != "n_lines") for i in range(len(texts))] == [
        base_metrics(t) for t in texts]
