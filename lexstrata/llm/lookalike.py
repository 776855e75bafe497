"""One form for texts that look the same (problem 4).

Method: a longest-match transducer over grapheme clusters. Its mapping is computed once from Unicode properties (what
programs may ignore, kinds of space, width and no-break forms, composition of accents) and tables and name rules of
look-alike letters, checked for conflicts, and compiled into one pattern that stops only at clusters that may change; each distinct cluster is looked up, so a text is rewritten in one
pass. What differs visibly (case, punctuation, accents, superscripts, symbols, line breaks) is kept apart.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.functions.runtime import written

#: Letters of other scripts, and other forms of letters, that look like Latin ones (fixed values).
LOOKALIKES = {
    "Cyrillic": "аa еe оo рp сc уy хx іi ѕs јj һh ԁd ԛq ԝw ӏl ѵv АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЅS ЈJ ԌG ԚQ ԜW Ӏl",
    "Greek": "αa οo νv ιi ρp υu ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϳj ͿJ",
    "Coptic": "ⲟo ⲣp ⲥc ⲓi ⲭx ⲀA ⲂB ⲈE ⲎH ⲒI ⲔK ⲘM ⲚN ⲞO ⲢP ⲤC ⲦT ⲨY ⲬX ⲌZ",
    "Armenian": "օo հh ոn սu քp ցg զq Օo ՏS ԼL",
    "Cherokee": "ᎪA ᏴB ᏟC ᎠD ᎬE ᏀG ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᏒR ᏚS ᎢT ᏙV ᎳW ᏃZ",
    "Latin": "ɑa ɡg ſs",
}
#: Scripts whose letters are named after the Latin letters they look like, and the letters of those names (fixed values).
NAMED = {"LISU LETTER": "BA DA EA FA GA HA JA KA LA MA NA PA RA SA TA VA WA XA YA ZA"}


def look_alike_letters() -> Iterator[tuple[str, str]]:
    """(letter, Latin letter) pairs: the fixed ones, those of NAMED scripts, and Roman numerals by their compatibility forms."""
    for pairs in LOOKALIKES.values():
        for source, target in pairs.split():
            yield source, target
    for script, letters in NAMED.items():
        for name in [*letters.split(), *"AEIOU"]:
            try:
                yield unicodedata.lookup(f"{script} {name}"), name[0]
            except KeyError:
                continue
    for code in range(0x2160, 0x2180):
        yield chr(code), unicodedata.normalize("NFKC", chr(code))


def _of_property(pattern: str) -> list[str]:
    """All characters outside ASCII and private use that the pattern of a Unicode property takes."""
    every = "".join(chr(c) for a, b in ((0x80, 0xD800), (0xF900, 0x20000), (0xE0000, 0xE1000)) for c in range(a, b))
    return regex.findall(pattern, every)


@cache
def invisible() -> frozenset[str]:
    """Characters that show nothing: all that Unicode lets programs ignore (joiners, direction marks, variation selectors, fillers, tags)."""
    return frozenset(_of_property(r"\p{Default_Ignorable_Code_Point}"))


def single_rules() -> dict[str, str]:
    """The mapping of single characters, from Unicode properties and the letters; raises if two rules disagree or a result is changed by another rule."""
    rules: dict[str, str] = {}

    def add(source: str, target: str) -> None:
        if rules.setdefault(source, target) != target:
            raise ValueError(f"two targets for {source!r}: {rules[source]!r} and {target!r}")

    for c in invisible():
        add(c, "")
    for c in _of_property(r"\p{Zs}"):
        add(c, " ")
    for c in map(chr, range(0x2000, 0x10000)):
        kind, _, form = unicodedata.decomposition(c).partition(" ")
        if c not in rules and kind in ("<wide>", "<narrow>", "<noBreak>"):
            add(c, "".join(chr(int(x, 16)) for x in form.split()))
    for source, target in look_alike_letters():
        add(source, target)
    # a rule's result may be a character of another rule: follow it, but not in a circle
    for source in rules:
        target = rules[source]
        for _ in range(4):
            onward = "".join(rules.get(t, t) for t in target)
            if onward == target:
                break
            target = onward
        else:
            raise ValueError(f"{source!r} has no last form")
        rules[source] = target
    return rules


def _class(characters: list[str]) -> str:
    """A pattern's character class, as ranges."""
    codes, out, start = sorted(map(ord, characters)), [], None
    for a, b in zip(codes, [*codes[1:], -1]):
        start = a if start is None else start
        if b != a + 1:
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(a))}")
            start = None
    return "".join(out)


class Transducer:
    """Compiled form of the mapping."""

    def __init__(self):
        self.rules, self.hidden = single_rules(), invisible()
        marks = [chr(c) for c in range(0x300, 0x10000) if unicodedata.category(chr(c))[0] == "M" and chr(c) not in self.rules]
        hidden = list(invisible())
        marks += [c for c, t in self.rules.items() if t and unicodedata.category(t[0])[0] == "M"]
        trail = _class(marks) + _class(hidden)
        # a cluster: any character with the marks and invisible characters that follow it, or one beyond ASCII
        self.clusters = re.compile(f"[\\x00-\\x7f](?=[{trail}])[{trail}]+|[^\\x00-\\x7f][{trail}]*")
        self.memo: dict[str, str] = {}
        # texts without any of these are in the one form already
        folds = [c for c in map(chr, range(0x80, 0x10000)) if not 0xD800 <= ord(c) < 0xE000 and (unicodedata.normalize("NFC", c) != c or unicodedata.normalize("NFD", c)[0] in self.rules)]
        self.touched = frozenset([*self.rules, *marks, *folds])
        self.touching = re.compile(f"[{_class(sorted(self.touched))}]").search

    def cluster(self, text: str) -> str:
        """The form of one cluster: single rules, then composition of its accents."""
        mapped = "".join([self.rules.get(c, c) for c in unicodedata.normalize("NFC", "".join(c for c in text if c not in self.hidden))])
        mapped = unicodedata.normalize("NFC", mapped)
        # a look-alike letter with its accent is one character in its own script; take it apart to reach the letter
        if len(mapped) == 1 and ord(mapped) > 127:
            parts = unicodedata.normalize("NFD", mapped)
            if len(parts) > 1 and parts[0] in self.rules:
                mapped = unicodedata.normalize("NFC", "".join(self.rules.get(c, c) for c in parts))
        return mapped

    def apply(self, text: str) -> str:
        if text.isascii() or not self.touching(text):
            return text
        memo = self.memo

        def one(match: re.Match) -> str:
            found = match[0]
            out = memo.get(found)
            if out is None:
                if len(memo) > 200_000:
                    memo.clear()
                out = memo[found] = self.cluster(found)
            return out

        return self.clusters.sub(one, text)


@cache
def transducer() -> Transducer:
    """One per worker process."""
    return Transducer()


def canonical(df: DataFrame, text_col: str = "testo", out_col: str = "canonical") -> DataFrame:
    """``df`` with ``out_col``, the one form of ``text_col``; null stays null, empty stays empty.

    A column of the same name is replaced.
    """

    names = [c for c in df.columns if c != out_col]
    at = names.index(text_col)
    out = T.StructType([*(df.schema[c] for c in names), T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = transducer().apply
        for batch in batches:
            new = pa.array([None if t is None else apply(t) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=out.names)

    return df.select(*names).mapInArrow(run, out)


def looks(df: DataFrame, id_col: str = "block_id", text_col: str = "testo") -> DataFrame:
    """id, key of the look (16 bytes), key of the text (8 bytes) of each row with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = transducer().apply
        for batch in batches:
            texts = batch.column(1).to_pylist()
            form = [apply(t) for t in texts]
            look = [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in form]
            own = [int.from_bytes(k[:8], "little", signed=True) if f == t else int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for t, f, k in zip(texts, form, look)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(look, pa.binary()), pa.array(own, pa.int64()), pa.array([f != t for f, t in zip(form, texts)], pa.bool_())], names=["id", "look", "own", "changed"])

    return df.select(id_col, text_col).where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, look binary, own bigint, changed boolean")


def alike(df: DataFrame, id_col: str = "block_id", text_col: str = "testo") -> DataFrame:
    """(id, look, own) of the rows whose look a changed text has; rows delivered twice come once."""
    every = written(looks(df, id_col, text_col), "forms")
    changed = every.where("changed").select("look").distinct()
    return every.join(changed, "look", "left_semi").select("id", "look", "own").distinct()


def look_links(df: DataFrame, id_col: str = "block_id", text_col: str = "testo") -> DataFrame:
    """id, look (number of the class), rows of the class and links (rows of it with another text), of rows with at least one link.

    The form for large groups: one row for each id, however many pairs there are. Cases as in ``same_look_pairs``.
    """
    rows = written(alike(df, id_col, text_col), "looks")
    texts = rows.groupBy("look", "own").agg(F.count(F.lit(1)).alias("same"))
    sizes = texts.groupBy("look").agg(F.sum("same").alias("rows"))
    held = rows.join(texts, ["look", "own"]).join(sizes, "look")
    return held.select("id", F.xxhash64("look").alias("look"), "rows", (F.col("rows") - F.col("same")).alias("links")).where("links > 0")


def same_look_pairs(df: DataFrame, id_col: str = "block_id", text_col: str = "testo") -> DataFrame:
    """(a, b), smaller id first: rows whose texts are not identical but look the same.

    A look with only one text has no pair, so only the looks of texts that the transducer changes are followed. Texts of
    one look are joined text by text and only then expanded to rows: a text that many rows repeat is never compared with
    its own copies. Null texts and ids match nothing; empty texts are equal, not look-alikes, but a text of invisible
    characters looks like the empty one; rows delivered twice count once; an empty table gives no pair.
    """
    rows = written(alike(df, id_col, text_col), "looks")
    texts = rows.select("look", "own").distinct()
    two = texts.select("look", F.col("own").alias("x")).join(texts.select("look", F.col("own").alias("y")), "look").where("x < y")
    first = two.join(rows.select("look", F.col("own").alias("x"), F.col("id").alias("p")), ["look", "x"])
    both = first.join(rows.select("look", F.col("own").alias("y"), F.col("id").alias("q")), ["look", "y"])
    return both.where("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
