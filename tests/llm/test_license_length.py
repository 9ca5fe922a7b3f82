"""Licence expressions in long texts: linear time, and output no larger than the text."""

import time

import pytest

from shardloom.llm import licenses

TAG = "SPDX-License-Identifier:"
LONG = {
    "tags on one line": f"{TAG} MIT " * 160_000,
    "tags without an expression": f"{TAG} " * 200_000,
    "one chain of and": f"{TAG} mit" + " and mit" * 600_000,
    "one chain of or with names of its own": f"{TAG} mit" + "".join(f" or LicenseRef-{i}" for i in range(250_000)),
    "nested brackets": f"{TAG} " + "(" * 2_400_000 + "mit" + ")" * 2_400_000,
    "brackets that never close": f"{TAG} " + "(mit and " * 500_000,
    "brackets that never open": f"{TAG} mit" + ")" * 4_500_000,
    "a chain of with": f"{TAG} gpl-2.0" + " with classpath-exception-2.0" * 170_000,
    "blanks": f"{TAG}" + " " * 5_000_000 + "mit",
}


@pytest.mark.parametrize("name", LONG)
def test_long_texts_take_linear_time(name):
    text = LONG[name]
    assert len(text) > 3_500_000
    began = time.time()
    found = licenses.scan_text(text, licenses.build_automaton())
    assert time.time() - began < 20
    assert sum(map(len, found["expressions"])) <= len(text)
    assert sum(map(len, found["labels"])) <= len(text)


def test_each_tag_of_a_line_has_its_own_expression():
    found = licenses.scan_text(f"# {TAG} MIT OR (ISC AND Zlib) */ {TAG} {TAG} GPL-2.0 with Classpath-exception-2.0 more words {TAG}\nmit", licenses.build_automaton())
    assert found["expressions"] == ["MIT OR (ISC AND Zlib)", "GPL-2.0 with Classpath-exception-2.0"]
    assert found["labels"] == ["gpl-2.0 with classpath-exception-2.0", "isc", "mit", "zlib"]
    assert found["permitted"] is False


def test_expressions_are_stored_as_parsed_and_no_further():
    found = licenses.scan_text(f"{TAG} MIT\tand ISC, see the file\n{TAG} (mit or\nisc)\n{TAG} and mit\n{TAG} mit) or zlib", licenses.build_automaton())
    assert found["expressions"] == ["MIT\tand ISC"]
    assert licenses.evaluate("mit with x with y") is None and licenses.evaluate("(mit) with x") == (True, ["mit with x"])
