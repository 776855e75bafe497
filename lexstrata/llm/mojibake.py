"""Detection and repair of text decoded with a wrong character encoding (problem 10).

Method: a multinomial classifier over hashed byte bigrams is trained on records garbled on purpose, one class for each
encoding chain, one for each decoding that loses characters and one for clean text. It scores every word that holds characters beyond ASCII; the chain is inverted
word by word and counts only where encoding and decoding succeed strictly. Neighbouring invertible words form a passage,
whose log-likelihood ratio against clean text is summed: a single foreign word that happens to be invertible is
outweighed by its neighbours.

Words repeat, so a worker scores each distinct one once; the operator itself is a map without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from functools import cache
from types import MappingProxyType

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encoding chains (fixed values): each step is (the encoding the bytes were in, the one they were read as).
CHAINS: dict[str, tuple[tuple[str, str], ...]] = {
    "utf8>cp1252": (("utf-8", "cp1252"),),
    "utf8>latin1": (("utf-8", "latin-1"),),
    "utf8>cp1252 twice": (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    "utf8>latin1 twice": (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    "utf8>cp437": (("utf-8", "cp437"),),
    "utf8>cp850": (("utf-8", "cp850"),),
    "utf8>mac_roman": (("utf-8", "mac_roman"),),
    "utf8>cp1250": (("utf-8", "cp1250"),),
    "utf8>cp1251": (("utf-8", "cp1251"),),
    "cp1252>cp437": (("cp1252", "cp437"),),
    "cp1252>cp850": (("cp1252", "cp850"),),
    "cp1252>cp1250": (("cp1252", "cp1250"),),
    "cp1252>cp1251": (("cp1252", "cp1251"),),
    "cp1252>latin1": (("cp1252", "latin-1"),),
}
#: Decodings that lose characters (fixed values): the encoding the bytes were in, the one they were read as with replacements.
LOSSES = {"lost cp1252>utf8": ("cp1252", "utf-8"), "lost utf8>ascii": ("utf-8", "ascii"), "lost cp1252>ascii": ("cp1252", "ascii")}
NAMES = ["clean", *CHAINS, *LOSSES]

#: Scripts whose letters are clean among themselves, whatever the training records hold, and the weight of a pair.
SCRIPTS, PRIOR = "Latin Greek Cyrillic Armenian Hebrew Arabic Devanagari Hiragana Katakana Hangul Han".split(), 0.05
#: Weights of a capital at the start of a word and of a letter inside one, and pairs of each letter with others of its script.
CAPITAL, INNER, PARTNERS = 0.5, 0.3, 13
#: Weight of a symbol that stands by itself or beside a letter.
SYMBOL = 2.0
#: Places of hashed byte bigrams, and of pairs and triples of characters, of which there are more.
BUCKETS, CHARACTER_BUCKETS = 1 << 13, 1 << 18
#: Log-likelihood ratio a passage must reach, and the weight of one unseen feature.
THRESHOLD, SMOOTHING = 3.5, 0.05
#: Texts that the classifier is fitted on, about.
TRAINING_ROWS = 1500
SPACES = str.maketrans("\n\r\t\f\v", "     ")
REPLACED = "�"


def _encode(text: str, encoding: str) -> bytes:
    """Strict, but code points of C1 controls stand for bytes that the code page leaves undefined."""
    if encoding in ("utf-8", "latin-1"):
        return text.encode(encoding)
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        return b"".join(bytes([ord(c)]) if 0x80 <= ord(c) < 0xA0 else c.encode(encoding) for c in text)


def _decode(data: bytes, encoding: str) -> str:
    if encoding in ("utf-8", "latin-1"):
        return data.decode(encoding)
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        out = []
        for b in data:
            try:
                out.append(bytes([b]).decode(encoding))
            except UnicodeDecodeError:
                out.append(chr(b))
        return "".join(out)


def garble(text: str, chain: str) -> str | None:
    """``text`` as the chain spoils it; None where it can't pass."""
    try:
        for right, wrong in CHAINS[chain]:
            text = _decode(text.encode(right), wrong)
    except UnicodeError:
        return None
    return text


def lose(text: str, loss: str) -> str | None:
    """``text`` as a decoding with replacements spoils it."""
    right, wrong = LOSSES[loss]
    try:
        return text.encode(right).decode(wrong, "replace")
    except UnicodeError:
        return None


def invert(text: str, chain: str) -> str | None:
    """The original of a garbled word, or None if it isn't strictly decodable."""
    try:
        for right, wrong in reversed(CHAINS[chain]):
            text = _encode(text, wrong).decode(right)
    except UnicodeError:
        return None
    return text


def features(word: str) -> np.ndarray:
    """Hashed byte bigrams that touch a byte beyond ASCII."""
    b = np.frombuffer(b" " + word.encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8).astype(np.uint32)
    left, right = b[:-1], b[1:]
    keep = (left > 127) | (right > 127)
    return (((left[keep] << 8 | right[keep]) * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int64) % BUCKETS


def characters(word: str) -> list[int]:
    """Hashed pairs and triples of characters that hold one beyond ASCII; to compare two readings of a word."""
    w = " " + word + " "
    out = []
    for i in range(1, len(w)):
        x, y = w[i - 1], w[i]
        if x > "\x7f" or y > "\x7f":
            out.append((ord(x) * 40503 + ord(y) * 2246822519) % CHARACTER_BUCKETS)
        if y > "\x7f" and i + 1 < len(w):
            out.append((ord(x) * 3266489917 + ord(y) * 668265263 + ord(w[i + 1]) * 374761393 + 97) % CHARACTER_BUCKETS)
    return out


@cache
def general_counts() -> tuple[np.ndarray, np.ndarray]:
    """Counts of what is clean in general, by Unicode properties: letters beside others of their script, and symbols by themselves and at words."""
    counts, plain = np.zeros(BUCKETS), np.zeros(CHARACTER_BUCKETS)

    def add(w: str, n: float) -> None:
        np.add.at(counts, features(w), n)
        np.add.at(plain, characters(w), n)

    every = "".join(map(chr, [*range(0x20, 0x700), *range(0x900, 0x980), *range(0x1E00, 0x2300), *range(0x2500, 0x2800), *range(0x3040, 0x3100), *range(0x4E00, 0x4E80), *range(0xAC00, 0xAC80)]))
    for script in SCRIPTS:
        letters = regex.findall(rf"[\p{{L}}&&\p{{{script}}}]", every, flags=regex.V1)
        plain_letters = [c for c in letters if c.isascii() and c.islower()] if script == "Latin" else letters
        for i, c in enumerate(letters):
            for k in range(0 if c.isascii() else PARTNERS):
                d = plain_letters[(i * 7 + k * 5) % len(plain_letters)]
                add(c + d, CAPITAL if c.isupper() else PRIOR)
                add(d + c.lower() + plain_letters[(i + k) % len(plain_letters)], INNER)
    for c in regex.findall(r"[\p{S}\p{P}\p{No}]", every):
        if not c.isascii():
            add(c, SYMBOL)
            for w in (c + "a", "a" + c, c + "A", c + "C", c + "1", "1" + c, "a" + c + ",", "a" + c + "."):
                add(w, SYMBOL / 5)
    return counts, plain


class ChainClassifier:
    """Multinomial model of the clean class and of each chain, over hashed byte bigrams."""

    def __init__(self, log: np.ndarray, plain: np.ndarray):
        self.log, self.plain = log, plain
        self.memo: dict[str, tuple[dict[int, tuple[float, str]], tuple[int, ...]] | None] = {}

    @classmethod
    def fit(cls, records: Sequence[str]) -> ChainClassifier:
        """Fits on ``records``, which are mostly clean.

        A second fit leaves out what the first found garbled. It has the words that were restored from more than one
        chain, so that words which the clean records lack are learned, but not what one chain makes of clean text.
        """
        first = cls._fit(records)
        clean: list[str] = []
        ways: dict[str, list[str]] = {}
        for r in records:
            hit = first.repair(r)
            if hit is None:
                clean.append(r)
            elif hit[2]:
                before = set(r.translate(SPACES).split(" "))
                for w in hit[2].translate(SPACES).split(" "):
                    if not w.isascii() and w not in before:
                        ways.setdefault(w, []).append(hit[0])
        return cls._fit(clean, {w: len(chains) for w, chains in ways.items() if len(set(chains)) > 1})

    @classmethod
    def _fit(cls, records: Sequence[str], restored: Mapping[str, int] = MappingProxyType({})) -> ChainClassifier:
        weights: dict[str, float] = {}
        for text in records:
            for w in text.translate(SPACES).split(" "):
                if w and not w.isascii():
                    weights[w] = weights.get(w, 0.0) + 1.0
                    weights[w.upper()] = weights.get(w.upper(), 0.0) + 0.1
        for w, n in weights.items():  # rare words may be garbled ones that the first fit missed
            if n < 6:
                weights[w] = 0.2 * n
        for w, n in restored.items():
            weights[w] = weights.get(w, 0.0) + n
        counts = np.full((len(NAMES), BUCKETS), SMOOTHING)
        plain = np.full(CHARACTER_BUCKETS, SMOOTHING)
        counts[0] += general_counts()[0]
        plain += general_counts()[1]
        for w, n in weights.items():
            np.add.at(counts[0], features(w), n)
            np.add.at(plain, characters(w), n)
            for k, chain in enumerate(CHAINS, 1):
                spoiled = garble(w, chain)
                if spoiled is not None and spoiled != w:
                    np.add.at(counts[k], features(spoiled), n)
            for k, loss in enumerate(LOSSES, 1 + len(CHAINS)):
                spoiled = lose(w, loss)
                if spoiled is not None:
                    np.add.at(counts[k], features(spoiled), n)
        log = np.log(counts / counts.sum(axis=1, keepdims=True))
        return cls(log.astype(np.float32), np.log(plain / (plain.sum() - SMOOTHING * (CHARACTER_BUCKETS - BUCKETS))).astype(np.float32))

    def score(self, word: str) -> tuple[dict[int, tuple[float, str]], tuple[int, ...]] | None:
        """By chain: evidence and original; and the chains with clear evidence. None: no chain applies.

        The evidence is the log-likelihood ratio of the chain against clean text, but not more than what the original
        gains over the garbled word as clean text.
        """
        if not word.strip():
            return None
        f = features(word)
        clean, here = self.log[0, f].sum(), self.plain[characters(word)].sum()
        out = {}
        for k, chain in enumerate(CHAINS, 1):
            original = invert(word, chain)
            if original is None or original == word:
                continue
            gain = self.plain[characters(original)].sum() - here
            out[k] = (float(min(self.log[k, f].sum() - clean, gain)), original)
        for k in range(1 + len(CHAINS), len(NAMES)) if REPLACED in word else ():
            out[k] = (float(self.log[k, f].sum() - clean), word)  # nothing to invert
        return (out, tuple(k for k, (x, _) in out.items() if x > 1)) if out else None

    def lookup(self, word: str) -> tuple[dict[int, tuple[float, str]], tuple[int, ...]] | None:
        try:
            return self.memo[word]
        except KeyError:
            if len(self.memo) > 200_000:
                self.memo.clear()
            found = self.memo[word] = self.score(word)
            return found

    def repair(self, text: str | None) -> tuple[str, bool, str | None] | None:
        """(chains, whether all of the original is recovered, the text with what can be recovered) of a garbled text; None for a clean one.

        Every passage has the chain that explains it best: passages of all chains are taken in the order of their
        evidence, unless they overlap one taken before.
        """
        if not text or text.isascii():
            return None
        words = text.translate(SPACES).split(" ")
        odd = [w for w in words if not w.isascii()]
        found = [self.lookup(w) for w in odd]
        spans: list[tuple[float, int, int, int]] = []
        for k in {k for x in found if x for k in x[1]}:
            seen: set[str] = set()  # a word's evidence counts once, however often it is repeated
            evidence = []
            for w, x in zip(odd, found):
                mass = x[0][k][0] if x and k in x[0] else None
                evidence.append(mass if mass is None or mass < 0 or w not in seen else 0.01)
                seen.add(w)
            spans += [(mass, k, a, b) for mass, a, b in passages(evidence)]
        if not spans:
            return None
        chain: dict[int, int] = {}
        used: dict[int, float] = {}
        for mass, k, a, b in sorted(spans, key=lambda s: (-s[0], s[1])):
            if not any(i in chain for i in range(a, b)):
                chain.update(dict.fromkeys(range(a, b), k))
                used[k] = used.get(k, 0.0) + mass
        out, i, pos = [], -1, 0
        for w in words:
            new = w
            if not w.isascii():
                i += 1
                if i in chain:
                    new = found[i][0][chain[i]][1]
            pos += len(w)
            out.append(new)
            if pos < len(text):
                out.append(text[pos])
                pos += 1
        lost = any(k > len(CHAINS) for k in used)
        restored = "".join(out)
        return ", ".join(NAMES[k] for k in sorted(used, key=lambda k: -used[k])), not lost, restored if restored != text else None


def passages(evidence: list[float | None]) -> Iterator[tuple[float, int, int]]:
    """(evidence, first, end) of the passages whose summed evidence reaches THRESHOLD; None can't be in a passage."""
    start = at = 0
    mass = peak = 0.0
    top = 0
    while at <= len(evidence):
        x = evidence[at] if at < len(evidence) else None
        if x is None or mass + x <= 0 or mass + x < peak - THRESHOLD:
            if peak >= THRESHOLD:
                yield peak, start, top
            if x is not None and mass + x > 0 and x > 0:
                start, mass, peak, top = at, x, x, at + 1
            else:
                start, mass, peak = at + 1, 0.0, 0.0
        else:
            if mass == 0:
                start = at
            mass += x
            if mass > peak:
                peak, top = mass, at + 1
        at += 1


def sample_texts(df: DataFrame, id_col: str, text_col: str, rows: int) -> list[str]:
    """About ``rows`` texts, chosen by the hash of their id; the bound holds at every size of ``df``."""
    wide = 1_000_000
    part = min(wide, int(np.ceil(wide * rows / max(1, df.count()))))
    hashed = F.pmod(F.xxhash64(F.col(id_col)), F.lit(wide))
    picked = df.where(F.col(text_col).isNotNull() & (hashed < part)).select(F.col(text_col).alias("text"))
    return sorted(r.text for r in picked.limit(2 * rows).collect())


def find_garbled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """``id_col``, ``chain``, ``recovered`` and ``restored`` of each garbled row of ``df``.

    The classifier is fitted on the driver, on about ``training_rows`` (2 x at most) texts of ``df`` chosen by hash and
    garbled on purpose; every row is then classified. ``chain`` names the chains of its passages, the strongest first;
    passages that lost characters can't be recovered, but ``restored`` has what the other passages said, and is null
    where nothing can be. Null, empty and blank texts and all clean ones give no row; repeated rows each give one; other
    columns are ignored; an empty table gives no rows.
    """
    fitted = ChainClassifier.fit(sample_texts(df, id_col, text_col, training_rows))
    log, plain = fitted.log, fitted.plain
    schema = T.StructType([df.schema[id_col], T.StructField("chain", T.StringType()), T.StructField("recovered", T.BooleanType()), T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ChainClassifier(log, plain)
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                hit = model.repair(text)
                if hit:
                    at.append(i)
                    rows.append(hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.string())],
                names=schema.names,
            )

    return df.select(id_col, text_col).mapInArrow(run, schema)
