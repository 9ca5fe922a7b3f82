"""License scan: Aho-Corasick over identifier tags and notice phrases, and licence expressions by shunting-yard.

One pass over the texts, no shuffle; a worker holds one automaton and one batch.

A text is lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters.
Phrases match where their words stand consecutively, overlaps included. Where the automaton finds an identifier
tag and a colon follows it, an expression is parsed from there to the end of the line, with ``with`` binding over ``and`` over ``or``. Reading
stops where an expression can't go on, and the next one is looked for behind it, so tags inside an expression start none; only what was parsed is stored.
Identifiers that are known, and references of one's own, become labels. The time is linear in the text, and so is the output.

Edge cases: a null text is an empty one; empty texts have no places, empty labels and score 0; a
malformed expression adds no label and leaves ``expressions`` untouched; unknown identifiers stay in
``expressions`` and are no labels; of very long texts nothing is left out; every row gives one row,
repeated or not; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import small_batches

#: Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notice phrases and their labels.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "all rights reserved": "all-rights-reserved",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "gnu affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
#: Licences and exceptions that the default policy of ``permitted`` accepts, by lower-case identifier.
PERMISSIVE = frozenset({"0bsd", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "cc-by-4.0", "cc0-1.0", "isc", "mit", "unlicense", "zlib"})

#: Public identifiers of licences and exceptions that become labels, in lower case.
KNOWN = frozenset(
    """0bsd afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause
    bsd-3-clause bsd-4-clause bsl-1.0 cc-by-2.0 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0
    cecill-2.1 curl ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.3-only gfdl-1.3-or-later gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0
    gpl-3.0-only gpl-3.0-or-later isc lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later mit mit-0 mpl-1.1
    mpl-2.0 ms-pl ms-rl ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
    autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 font-exception-2.0 gcc-exception-3.1 linux-syscall-note llvm-exception openvpn-openssl-exception""".split()
)

_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_COLON = re.compile(r"[ \t]*:[ \t]*")
_TOKEN = re.compile(r"[^\S\n\r]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_RANK = {"or": 1, "and": 2, "with": 3}
_SEPARATORS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def read_expression(text: str, at: int = 0) -> tuple[list[str] | None, int]:
    """(postfix order, end) of the licence expression that begins at ``at``, by shunting-yard; None if it is malformed.

    Reading stops at the line's end and at the first token that can't be part of an expression (a comment's end, say, or another tag's first word).
    """
    out: list[str] = []
    stack: list[str] = []
    deep, operand = 0, True
    while (m := _TOKEN.match(text, at)) is not None:
        bracket, word = m.groups()
        low = word.lower() if word else bracket
        if low.rstrip(":") == TAG.replace(" ", "-"):
            break
        if low == "(":
            if not operand:
                break
            stack.append(low)
            deep += 1
        elif low == ")":
            if operand or not deep:
                return None, m.end()
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            deep -= 1
        elif low in _RANK:
            if operand:
                return None, m.end()
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        else:
            if not operand:
                break
            out.append(low)
            operand = False
        at = m.end()
    if operand or deep:
        return None, at
    return out + stack[::-1], at


def judge(postfix: list[str], allowed: frozenset[str] = PERMISSIVE) -> tuple[bool, list[str]] | None:
    """(permitted, identifiers) of an expression: ``or`` needs one side, ``and`` both, ``x with y`` needs x, and both of these are names."""
    names: list[str] = []
    stack: list[tuple[bool, bool]] = []  # permitted, is a single name
    for x in postfix:
        if x not in _RANK:
            stack.append((x in allowed, True))
            names.append(x)
            continue
        (right, name_b), (left, name_a) = stack.pop(), stack.pop()
        if x == "with":
            if not (name_a and name_b):
                return None
            exception = names.pop()
            names[-1] += f" with {exception}"
            stack.append((left, False))
        else:
            stack.append((left and right if x == "and" else left or right, False))
    return stack[0][0], names


def evaluate(text: str, allowed: frozenset[str] = PERMISSIVE) -> tuple[bool, list[str]] | None:
    """``judge`` of the expression with which a text begins; None if it is malformed."""
    postfix, _ = read_expression(text)
    return None if postfix is None else judge(postfix, allowed)


def is_known(name: str) -> bool:
    """Whether every identifier of ``x`` or ``x with y`` is known, ``x+`` included, or a reference to a licence text."""
    return all(x.removesuffix("+") in KNOWN or x.startswith(("licenseref-", "documentref-")) for x in name.split(" with "))


def build_automaton() -> ahocorasick.Automaton:
    """Every phrase between blanks, with (words in it, label, is base)."""
    automaton = ahocorasick.Automaton()
    for phrases, base in ((NOTICES, False), (BASE, True)):
        for phrase, label in phrases.items():
            automaton.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, base))
    automaton.add_word(f" {TAG} ", (3, None, False))
    automaton.make_automaton()
    return automaton


def scan_text(text: str, automaton: ahocorasick.Automaton, allowed: frozenset[str] = PERMISSIVE) -> dict:
    """All places and labels of one text; ``places`` holds (first word, label) of base phrases."""
    tokens = text.encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()
    line = " " + b" ".join(tokens).decode("utf-8", "surrogatepass") + " "
    places, base, labels, tags, notices, at, blanks = [], set(), set(), [], [], 0, 0
    for end, (n, label, is_base) in automaton.iter(line):
        blanks += line.count(" ", at, end + 1)  # hits come in the order of their ends
        at, start = end + 1, blanks - 1 - n
        if label is None:
            tags.append(start + n)
            continue
        if is_base:
            places.append((start, label))
            base.add(label)
        notices.append((start, n, label))
        labels.add(label)
    expressions, permitted, done = [], [], 0
    if tags:
        wanted = set(tags)
        ends = [m.end() for number, m in enumerate(_WORD.finditer(text), 1) if number in wanted]
        for at in ends:
            m = _COLON.match(text, at) if at >= done else None
            if m is None:
                continue
            postfix, done = read_expression(text, m.end())
            if postfix is not None and (found := judge(postfix, allowed)) is not None:
                expressions.append(text[m.end() : done].strip())
                permitted.append(found[0])
                labels.update(x for x in found[1] if is_known(x))
    return {
        "n_words": len(tokens), "places": sorted(places), "base": sorted(base), "labels": sorted(labels), "notices": sorted(notices),
        "expressions": expressions, "permitted": all(permitted) if permitted else None,
        "score": 1.0 if expressions else 0.9 if places else 0.5 if labels else 0.0,
    }


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, "
    "notices array<struct<word:long,n_words:int,label:string>>, expressions array<string>, permitted boolean"
)


def scan_licenses(docs: DataFrame, allowed: frozenset[str] = PERMISSIVE) -> DataFrame:
    """One row per document: phrase places, labels, expressions and whether the policy ``allowed`` permits them."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            found = [scan_text(t or "", automaton, allowed) for t in batch.column(1).to_pylist()]
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x["n_words"] for x in found], pa.int64()),
                    pa.array([len(x["places"]) for x in found], pa.int64()),
                    pa.array([x["places"][0][0] if x["places"] else None for x in found], pa.int64()),
                    pa.array([x["places"][-1][0] if x["places"] else None for x in found], pa.int64()),
                    pa.array([x["base"] for x in found], strings),
                    pa.array([x["labels"] for x in found], strings),
                    pa.array([x["score"] for x in found], pa.float64()),
                    pa.array([[{"word": a, "n_words": b, "label": c} for a, b, c in x["notices"]] for x in found], pa.list_(pa.struct([("word", pa.int64()), ("n_words", pa.int32()), ("label", pa.string())]))),
                    pa.array([x["expressions"] for x in found], strings),
                    pa.array([x["permitted"] for x in found], pa.bool_()),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices", "expressions", "permitted"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, SCHEMA)
