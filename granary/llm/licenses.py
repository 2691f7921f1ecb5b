"""Licence scans: an Aho-Corasick pass finds notice phrases and identifier tags, and a shunting-yard
parser evaluates the licence expressions behind the tags."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import per_document

#: Fixed values of the contract: notice phrases in plain words, and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Further notice phrases of common licences.
MORE_PHRASES = (
    ("gnu general public license version 2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license version 2", "mpl-2"),
    ("eclipse public license", "epl"),
    ("bsd 2 clause license", "bsd-2-clause"),
    ("bsd 3 clause license", "bsd-3-clause"),
    ("under the bsd license", "bsd"),
    ("under the isc license", "isc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("cc0 1 0 universal", "cc0"),
    ("released into the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
)
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.ASCII | re.IGNORECASE)
EXPRESSION_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*)")

#: How freely works under a licence can be used again, by the start of its label.
FREEDOM = (
    ("mit", 1.0), ("apache", 1.0), ("bsd", 1.0), ("isc", 1.0), ("cc0", 1.0), ("public-domain", 1.0),
    ("unlicense", 1.0), ("zlib", 1.0), ("cc-by-nc", 0.1), ("cc-by-nd", 0.2), ("cc-by-sa", 0.5),
    ("cc-by", 0.9), ("lgpl", 0.6), ("mpl", 0.6), ("epl", 0.6), ("agpl", 0.2), ("gpl", 0.3),
    ("all-rights-reserved", 0.0),
)
UNKNOWN_FREEDOM = 0.4
EXCEPTION_BONUS = 0.1
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

#: Words are ASCII letters and digits and everything beyond ASCII; the rest separates.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def label_of(identifier: str) -> str:
    """The label of a licence identifier: lower case, without ``-only``, ``-or-later``, ``+`` and ``.0``."""
    label = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    if label.startswith("cc-"):
        return re.sub(r"-[0-9]+(\.[0-9]+)*$", "", label)
    return label.removesuffix(".0")


def freedom(label: str) -> float:
    return next((f for start, f in FREEDOM if label.startswith(start)), UNKNOWN_FREEDOM)


def evaluate(expression: str) -> tuple[list[str], float] | None:
    """Labels and freedom of a licence expression, None where it does not parse.

    ``with`` binds tighter than ``and``, ``and`` tighter than ``or``; a choice is as free as its freest
    part, a combination as its least free one, and an exception adds a little.  The expression ends at
    the first character that can't belong to it, such as the end of a comment.
    """
    tokens, at = [], 0
    while match := EXPRESSION_TOKEN.match(expression, at):
        tokens.append(match[1])
        at = match.end()
    output: list[tuple[list[str], float]] = []
    waiting: list[str] = []

    def apply() -> bool:
        operator = waiting.pop()
        if operator == "(" or len(output) < 2:
            return False
        (right, b), (left, a) = output.pop(), output.pop()
        if operator == "with":
            output.append((left, min(1.0, a + EXCEPTION_BONUS)))
        else:
            output.append((left + right, max(a, b) if operator == "or" else min(a, b)))
        return True

    operand_due = True
    for token in tokens:
        word = token.lower()
        if word == "(":
            if not operand_due:
                return None
            waiting.append(word)
        elif word == ")":
            if operand_due:
                return None
            while waiting and waiting[-1] != "(":
                if not apply():
                    return None
            if not waiting:
                return None
            waiting.pop()
        elif word in PRECEDENCE:
            if operand_due:
                return None
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[word]:
                if not apply():
                    return None
            waiting.append(word)
            operand_due = True
        else:
            if not operand_due:
                break  # plain words after a whole expression
            label = label_of(token)
            output.append(([label], freedom(label)))
            operand_due = False
    if operand_due:
        return None
    while waiting:
        if not apply():
            return None
    return (sorted(set(output[0][0])), output[0][1]) if len(output) == 1 else None


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for phrase, label, base in [(TAG, "", False)] + [
        (p, x, b) for listed, b in ((BASE_PHRASES, True), (MORE_PHRASES, False)) for p, x in listed
    ]:
        automaton.add_word(f" {phrase} ", (len(phrase), label, base))
    automaton.make_automaton()
    return automaton


def scan_texts(texts: list[str]) -> dict[str, list]:
    """Words, places, labels and score of each text; all texts are scanned as one string."""
    data = np.frombuffer(b" \n " + b" \n ".join(t.encode().translate(_PLAIN) for t in texts) + b" \n ", dtype=np.uint8)
    space = data == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[0] = True
    data = data[keep]
    space = data == 0x20
    borders = np.flatnonzero(data == 0x0A)
    starts = space[:-1] & ~space[1:] & (data[1:] != 0x0A)
    words = np.concatenate([[0], np.cumsum(starts)])  # words that start at or before each byte
    found: list[list[dict]] = [[] for _ in texts]
    tagged = set()
    for end, (length, label, base) in _automaton().iter(data.tobytes().decode("latin-1")):
        i = int(np.searchsorted(borders, end)) - 1
        if label:
            word = int(words[end - length] - words[borders[i]]) - 1
            found[i].append({"word": word, "label": label, "base": base})
        else:
            tagged.add(i)
    counts = np.diff(words[borders])
    labels, scores = [], []
    for i, places in enumerate(found):
        parts = [([p["label"]], freedom(p["label"])) for p in places]
        if i in tagged:
            parts += filter(None, map(evaluate, TAG_LINE.findall(texts[i])))
        labels.append(sorted({x for some, _ in parts for x in some}))
        scores.append(min((f for _, f in parts), default=0.0))
    return {"n_words": counts.tolist(), "places": found, "labels": labels, "score": scores}


PLACES = "array<struct<word:bigint,label:string,base:boolean>>"


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``places`` (word number, label and whether the phrase is one of the base
    list), ``labels`` (of phrases and of licence expressions behind identifier tags) and ``score``: how
    freely a work under all of them can be used again, 0 where no licence is found.

    A null or empty text has no words, no labels and score 0; a null or repeated id is passed through, so
    every row gives one row; other columns are not read.  Nothing is shuffled.
    """

    def run(columns: list[list]) -> dict:
        made = scan_texts([t or "" for t in columns[0]])
        kind = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
        return made | {"places": pa.array(made["places"], type=kind)}

    return per_document(
        docs, {id: id, text: text}, run, f"n_words bigint, places {PLACES}, labels array<string>, score double"
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Counts and labels of each row: the base phrases alone, and all labels."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["word"])
    names = F.array_sort(F.array_distinct(F.transform(base, lambda p: p["label"])))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(names, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )
