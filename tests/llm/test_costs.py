"""Cheaper ways of p5_found's inner work give what the plain ways give."""

import numpy as np
import pyarrow as pa
import pytest

from tarnloom.llm import arrow, mainbody, tagpaths
from tarnloom.llm.gru import ByteGRU


@pytest.mark.parametrize("values", [[["a", None, "ß"], None, [], ["x"]], [[1, 2], [], None], [[1, None]], [[True], [False]], ["a", None], [1, None], [1.5, 2.0], [[["a"], None], []], [b"x", None]])
def test_lists_of_columns(values):
    column = pa.array(values)
    assert arrow.as_list(column) == values
    assert arrow.as_list(column[1:]) == values[1:]
    assert arrow.as_list(column[:0]) == []


@pytest.mark.parametrize("text", ["", "  ", "plain words, cut.", "a_b x53 3rd", "„Zitat“ – naïve x² ٣a", "a\0b\x1cc", "日本語、テスト", "́é\ud800"])
def test_words_cut_in_one_pass(text):
    assert arrow.cut_words(text) == arrow.WORD.findall(text)
    assert tagpaths.letters_of(text) == tagpaths.NOT_WORD.sub("", text)
    table = mainbody.LineWords(mainbody.BITS)
    plain = [x for line in (text, "x") for x in [*map(table.__getitem__, mainbody.WORD.findall(line.casefold())), -1]]
    assert mainbody.words_of_lines([text, "x"], table) == plain


def test_tags_are_cut_by_their_brackets():
    html = "a < b <1> <p class='x y'>c <b>d</b><BR/>e<a href='/z'>link</a></p><div/>f<<i>g</i> > <p"
    nodes = tagpaths.text_nodes(html)
    assert [(n.path.marks, n.text, n.linked) for n in nodes] == [((), "a < b <1>", 0), (("p.x y",), "c d e link", 4), ((), "f<g > <p", 0)]
    assert "p class='x y'" in tagpaths._TAGS and tagpaths._TAGS["1"][0] < 0


def test_probabilities_are_those_of_the_states():
    rng = np.random.default_rng(3)
    network = ByteGRU(5, 16, 1)
    network.b += 0.3
    network.c += np.arange(5, dtype=np.float32)
    data = rng.integers(0, 256, (7, 128)).astype(np.uint8)
    mask = rng.random((7, 128)) < 0.5
    logits = network.states(data) @ network.v + network.c
    p = np.exp(logits) / np.exp(logits).sum(-1, keepdims=True)
    assert network._by_step(data).shape == (5, 128, 7)
    assert np.allclose(network.positions(data), p, atol=1e-5)
    assert np.allclose(network.probabilities(data, mask), (p * mask.T[:, :, None]).sum(0), atol=1e-4)
