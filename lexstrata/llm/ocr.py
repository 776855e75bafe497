"""Repair of text from scanned pages (problem 6).

Method: words are counted over the whole corpus; frequent ones form a vocabulary trie. Each distinct word is intersected,
as a lazily built Levenshtein automaton, with the trie, which retrieves all vocabulary words within the distance; a
candidate stands if the difference consists of known confusions of recognition. How likely each confusion is, is learned
from the pairs of a misread word and its only candidate. Several candidates are ranked by that, by frequency and by how
often they stand beside the neighbouring words. Then page furniture is removed (running headers by their repetition over
pages, page numbers by the page), words divided at line and page ends are joined and paragraphs that pages interrupt are
reflowed.

Nothing that grows with the corpus is held by the driver or by every task. Vocabulary and words meet in groups of a block
of the vocabulary and a part of the words. What a text has to be compared with is a filter of fixed size; its hits are
joined with the corrections. Order within a file is cut into stretches; what a block needs of the blocks before and after
its stretch is carried over from one row for each stretch, so a file that holds a third of all rows is spread over many
tasks, and nothing is out of reach.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexstrata.functions.runtime import written
from lexstrata.llm.lookalike import transducer

#: Confusions of recognition (fixed values): printed, as read.
CONFUSIONS = "a@ o0 O0 i! i1 I1 l1 l| i| I| t+ s5 S5 g9 g6 G6 q9 b6 B8 z2 Z2 A4 T7 ec ce m~rn rn~m n~ri h~li li~h d~cl cl~d u~ii ti~n oO lI il li w~vv vv~w v~u u~v vy yv aà eè iì oò uù"
#: Marks that stand for a letter inside a word.
SYMBOLS = "@!+|0123456789$"
#: A correction is RATIO times as frequent as the word, more for words of up to three letters, which are nearer to each
#: other; a token with marks is no word itself, so a word that occurs twice corrects it.
RATIO, SHORT_RATIO, MARKED_LEAST, DISTANCE = 8, {2: 512, 3: 64}, 2, 2
#: Vocabulary words of a block and words of a part that meet in one group.
VOCABULARY_BLOCK, LOOKUP_BLOCK = 50_000, 100_000
#: Blocks in a stretch of a file, and rows that a task has in Python at a time.
STRETCH, ROWS = 512, 1000
#: Bits of the filter that tasks hold: 4 MB, however many words it stands for. It only saves joins; hits are joined exactly.
FILTER_BITS, FILTER_PART = 1 << 25, 1 << 15
#: Running lines come back on so many pages and this share of a file's pages; those written like a sentence on more.
HEADER_PAGES, HEADER_SHARE, SENTENCE_PAGES, SENTENCE_SHARE = 2, 0.2, 3, 0.5

HYPHENS = "-‐\xad¬"
DIVIDED = re.compile(rf"([^\W\d_]+)([{HYPHENS}])[ \t]*\r?\n[ \t]*([^\W\d_]+)")
AT_END = re.compile(rf"([^\W\d_]+)([{HYPHENS}])\s*$")
PLAIN = re.compile(r"[^\W\d_]+(?:[-‐][^\W\d_]+)*")
LONG_WORD = re.compile(r"[^\W\d_]{2}")
TOKEN = re.compile(rf"[\w{re.escape(SYMBOLS)}]+")
COMPOUND = re.compile(rf"[\w{re.escape(SYMBOLS)}]+(?:[-‐][\w{re.escape(SYMBOLS)}]+)*")
BROKEN = re.compile(rf"[{HYPHENS}][ \t]*\r?\n")
HEAD_NUMBER = re.compile(r"\W*(?:(?:page|pag|seite|página|p|s)\b\.?\s*)?(\d+)(?:\s*[–—|·\-]\s*|\s+)(?=\D)", re.I)
TAIL_NUMBER = re.compile(r"(?:\s*[–—|·\-]\s*|\s+)(?:(?:page|pag|seite|página|p|s)\b\.?\s*)?(\d+)\W*$", re.I)
CODE = re.compile(r"[A-Z0-9]+|[A-Z]{1,3}\d+[a-z]?|\d+(?:st|nd|rd|th|er|ère|e|a|o|ª|º|bis|ter)?")
NUMERAL = re.compile(r"(?=.*\d)(?=.*[lO])[\dlO]{2,}")
NUMERAL_INSIDE = re.compile(r"\d[lO]|[lO]\d")
#: Words that start a heading (fixed values).
HEADINGS = "art article articolo artículo artigo section sezione sección secção abschnitt subsection sous-section unterabschnitt chapter capo capítulo chapitre kapitel title titolo título titre titel part parte partie teil subpart schedule annex allegato anexo annexe anlage".split()
HEADING = re.compile(rf"^\W*(?:(?:sub|sous-|unter)?(?:{'|'.join(HEADINGS)})\b\.?\s+[\dlO]+|(?:sub|sous-|unter)?(?:{'|'.join(HEADINGS)})\b\.?\s+[IVXLCDM1l]+\b|§\s*\d+)", re.I)
MARKER = re.compile(r"^\W*(?:\(?\w{1,4}\)|\d{1,3}[.)])\s")
PAGE_NUMBER = re.compile(r"^[\s–—\-]*(?:(?:pages?|pag|seite|página|pagina|p|s)\b\.?\s*)?([\dlIoO]+|[ivxlcdm1]+)(?:\s*(/|di|of|de|von|sur)\s*([\dlIoO]+))?[\s–—\-]*$", re.I)
OPEN_ABBREVIATION = re.compile(r"(?:\b(?:n|nr|no|art|prot|abs|cfr|vgl)\.)$", re.I)


def _confusions() -> dict[str, set[str]]:
    """What a printed piece may be read as, in lower case."""
    out: dict[str, set[str]] = {}
    for pair in CONFUSIONS.split():
        printed, read = (pair.split("~") if "~" in pair else (pair[0], pair[1:]))
        if printed.lower() != read.lower():
            out.setdefault(printed.lower(), set()).add(read.lower())
    return out


READ_AS = _confusions()
#: Which letter can stand in the place of which, and letters that a confusion can add or drop; other edits explain nothing.
SWAPS = {(p, r) for printed, reads in READ_AS.items() for read in reads for p in printed for r in read}
LOOSE = {c for printed, reads in READ_AS.items() for read in reads if len(printed) != len(read) for c in printed + read}


def explained(printed: str, read: str, most: int = 4) -> tuple[str, ...] | None:
    """The fewest confusions (printed~read) that turn ``printed`` into ``read``; None if they can't."""
    best: dict[tuple[int, int], tuple[str, ...]] = {(0, 0): ()}

    def reach(at: tuple[int, int], way: tuple[str, ...]) -> None:
        if at not in best or len(way) < len(best[at]):
            best[at] = way

    for i in range(len(printed) + 1):
        for j in range(len(read) + 1):
            way = best.get((i, j))
            if way is None or len(way) > most:
                continue
            if i < len(printed) and j < len(read) and printed[i] == read[j]:
                reach((i + 1, j + 1), way)
            for n in (1, 2):
                piece = printed[i : i + n]
                for seen in READ_AS.get(piece, ()) if len(piece) == n else ():
                    if read.startswith(seen, j):
                        reach((i + n, j + len(seen)), (*way, f"{piece}~{seen}"))
    found = best.get((len(printed), len(read)))
    return found if found is not None and len(found) <= most else None


class Trie:
    """Vocabulary trie in arrays: the children of a node stand together, level by level; a word's end holds its count, and every node the largest count below it."""

    def __init__(self, words: dict[str, int]):
        held = sorted(words)
        self.first, self.last, self.counts = array("I"), array("I"), array("q", [words.get("", 0)])
        letters = ["\0"]
        level, depth = [(0, len(held))], 0
        while level:
            below = []
            for at, end in level:
                self.first.append(len(letters))
                at += at < end and len(held[at]) == depth
                while at < end:
                    c, stop = held[at][depth], at + 1
                    while stop < end and held[stop][depth] == c:
                        stop += 1
                    letters.append(c)
                    self.counts.append(words[held[at]] if len(held[at]) == depth + 1 else 0)
                    below.append((at, stop))
                    at = stop
                self.last.append(len(letters))
            level, depth = below, depth + 1
        self.letters = "".join(letters)
        self.most = array("q", self.counts)
        for node in range(len(letters) - 1, -1, -1):
            if self.first[node] < self.last[node]:
                self.most[node] = max(self.most[node], max(self.most[self.first[node] : self.last[node]]))

    def within(self, word: str, distance: int, least: int = 1, any_edit: bool = True) -> list[tuple[str, int]]:
        """All vocabulary words of at least ``least`` occurrences within the edit distance of ``word``, with their counts.

        The automaton's states are rows of the edit table capped at ``distance`` + 1; transitions are built when first
        used and shared by all branches of the trie that reach the same state. Without ``any_edit`` it has only the edits
        that confusions are made of, so branches that they can't explain end early.
        """
        dead = distance + 1
        start = tuple(min(i, dead) for i in range(len(word) + 1))
        steps: dict[tuple, dict[str, tuple | None]] = {start: {}}
        out: list[tuple[str, int]] = []
        stack = [(0, start, "")]
        letters, first, last, counts, most = self.letters, self.first, self.last, self.counts, self.most
        added = [1 if any_edit or w in LOOSE else dead for w in word]
        while stack:
            node, state, prefix = stack.pop()
            own = steps[state]
            for child in range(first[node], last[node]):
                if most[child] < least:
                    continue
                c = letters[child]
                if c in own:
                    nxt = own[c]
                else:
                    dropped = 1 if any_edit or c in LOOSE else dead
                    row = [min(state[0] + dropped, dead)]
                    for i, w in enumerate(word):
                        swapped = 0 if w == c else 1 if any_edit or (c, w) in SWAPS else dead
                        row.append(min(state[i + 1] + dropped, row[i] + added[i], state[i] + swapped, dead))
                    nxt = tuple(row) if min(row) <= distance else None
                    own[c] = nxt
                    if nxt is not None:
                        steps.setdefault(nxt, {})
                if nxt is not None:
                    if counts[child] >= least and nxt[-1] <= distance:
                        out.append((prefix + c, counts[child]))
                    stack.append((child, nxt, prefix + c))
        return out


def numeral(token: str) -> str | None:
    """The number that a token of digits and letters read for digits stands for.

    Numbers are no vocabulary; all of them are an automaton of one state, so the digits are the only candidate.
    """
    return token.replace("l", "1").replace("O", "0") if NUMERAL.fullmatch(token) else None


def joined_lines(text: str) -> str:
    """Text without the words divided at line ends; they prove nothing about the vocabulary."""
    if "\n" in text and BROKEN.search(text):
        text = DIVIDED.sub(" ", text)
    return AT_END.sub(" ", text) if text.rstrip()[-1:] in HYPHENS else text


def odd(token: str) -> bool:
    """Whether a token holds a mark or digit that may stand for a letter."""
    core = token.rstrip("!")
    if token.isalpha() or not any(c.isalpha() for c in token):
        return False
    if core.isalpha():
        return core != token
    return not CODE.fullmatch(token) and any(c.islower() for c in token)


def word_counts(blocks: DataFrame, text_col: str = "testo") -> DataFrame:
    """(word, n): words and hyphenated compounds in lower case, and tokens with marks as they are, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = transducer().apply
        for batch in batches:
            raw: Counter[str] = Counter()
            for at in range(0, batch.num_rows, ROWS):
                for text in batch.column(0).slice(at, ROWS).to_pylist():
                    if text:
                        raw.update(COMPOUND.findall(form(joined_lines(text))))
            n: Counter[str] = Counter()
            for token, k in raw.items():  # distinct tokens only
                if token.isalpha():
                    n[token.lower()] += k
                    continue
                parts = re.split("[-‐]", token)
                if len(parts) > 1 and all(p.isalpha() for p in parts):
                    n["-".join(parts).lower()] += k
                for p in parts:
                    if p.isalpha():
                        n[p.lower()] += k
                    elif odd(p):
                        n[p] += k
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    return blocks.select(text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def candidates(counts: DataFrame) -> DataFrame:
    """(word, good, m, ways): vocabulary words that confusions of recognition may have turned into ``word``.

    ``m`` is how often ``good`` occurs, ``ways`` the confusions. A block of the vocabulary and a part of the words are a
    group; every word meets every block.
    """
    vocabulary = counts.where(F.col("word").rlike(r"^[\p{L}\-‐]+$") & (F.col("n") >= MARKED_LEAST) & (F.length("word") >= 2))
    lookups = counts.where((F.length("word") >= 2) & ~F.col("word").contains("-")).select("word", "n")
    blocks, words = vocabulary.count(), lookups.count()
    parts, salts = max(1, -(-blocks // VOCABULARY_BLOCK)), max(counts.sparkSession.sparkContext.defaultParallelism, -(-words // LOOKUP_BLOCK))
    part, salt = F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int"), F.pmod(F.xxhash64("word"), F.lit(salts)).cast("int")
    left = vocabulary.select("word", "n", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    right = lookups.select("word", "n", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), salt.alias("salt"))

    def match(held: pa.Table, asked: pa.Table) -> pa.Table:
        trie = Trie(dict(zip(held.column("word").to_pylist(), held.column("n").to_pylist()))) if asked.num_rows else None
        out: list[tuple[str, str, int, tuple[str, ...]]] = []
        for word, n in zip(asked.column("word").to_pylist(), asked.column("n").to_pylist()):
            low = word.lower()
            marks = sum(not c.isalpha() for c in low)
            least = MARKED_LEAST if marks else n * SHORT_RATIO.get(len(low), RATIO)
            for good, m in trie.within(low, max(1 if len(low) < 4 else DISTANCE, min(marks, 3)), least, any_edit=False):
                if good != low and (ways := explained(good, low)):
                    out.append((word, good, m, ways))
        columns = list(zip(*out)) if out else [()] * 4
        return pa.table({"word": pa.array(columns[0], pa.string()), "good": pa.array(columns[1], pa.string()), "m": pa.array(columns[2], pa.int64()), "ways": pa.array([list(w) for w in columns[3]], pa.list_(pa.string()))})

    groups = parts * salts
    sides = [df.repartition(groups, "part", "salt").groupBy("part", "salt") for df in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(match, "word string, good string, m bigint, ways array<string>")


def confusion_weights(found: DataFrame) -> dict[str, float]:
    """Log-likelihood of each confusion, learned from the words with one candidate; there are as many as in CONFUSIONS."""
    single = found.groupBy("word").agg(F.count(F.lit(1)).alias("k"), F.first("ways").alias("ways")).where("k = 1")
    seen = {r.way: r.n for r in single.select(F.explode("ways").alias("way")).groupBy("way").agg(F.count(F.lit(1)).alias("n")).collect()}
    every = [f"{printed}~{read}" for printed, reads in READ_AS.items() for read in reads]
    total = sum(seen.values()) + len(every)
    return {way: math.log((seen.get(way, 0) + 1) / total) for way in every}


def word_filter(words: DataFrame) -> bytes:
    """A bit set of FILTER_BITS hashed places that holds the column ``word``; at most FILTER_BITS / FILTER_PART rows are collected."""
    place = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(FILTER_BITS))
    parts = words.select(F.floor(place / FILTER_PART).alias("part"), F.pmod(place, F.lit(FILTER_PART)).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for r in parts.collect():
        out[r.part * FILTER_PART // 8 : (r.part + 1) * FILTER_PART // 8] = r.bits[: FILTER_PART // 8]
    return bytes(out)


class Suspects:
    """Looks words up in the filter."""

    def __init__(self, bits: bytes):
        self.bits = bits
        self.memo: dict[str, str | None] = {}
        self.clean: set[str] = set()  # tokens known to be neither

    def held(self, word: str) -> bool:
        at = zlib.crc32(word.encode("utf-8", "surrogatepass")) % FILTER_BITS
        return bool(self.bits[at >> 3] >> (at & 7) & 1)

    def among(self, tokens: set[str]) -> tuple[list[str], bool]:
        """The words that stand for the tokens in the corrections, as far as the filter holds them, and whether a token is a misread number."""
        words, numbers = set(), False
        for token in tokens - self.clean:
            word, number = self(token), bool(NUMERAL.fullmatch(token))
            numbers |= number
            if word:
                words.add(word)
            elif not number:
                if len(self.clean) > 200_000:
                    self.clean.clear()
                self.clean.add(token)
        return sorted(words), numbers

    def __call__(self, token: str) -> str | None:
        """The word that stands for a token in the corrections, if the filter may hold it."""
        try:
            return self.memo[token]
        except KeyError:
            word = token.lower() if token.isalpha() and token in (token.lower(), token.capitalize(), token.upper()) else token
            if len(self.memo) > 100_000:
                self.memo.clear()
            code = len(token) < 4 and token.isupper()  # an abbreviation, not a word
            found = self.memo[token] = word if len(word) > 1 and not code and self.held(word) else None
            return found


def _fold_tables() -> tuple[bytes, bytes, bytes]:
    """Byte tables of Latin-1 and of UTF-8 and the bytes that are dropped: single characters that misread variants share, accents by their decompositions."""
    shared = dict(zip("01!|l+56b89q@42eh7yu", "oiiiitsgggggaazcutvv"))
    latin, other = bytearray(range(256)), bytearray(range(256))
    for code in range(256):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii():
            latin[code] = ord(shared.get(base, base))
        if code < 128:
            other[code] = latin[code]
    return bytes(latin), bytes(other), bytes(c for c in range(128) if not chr(c).isalnum() and chr(c) not in SYMBOLS.replace("$", ""))


FOLD_LATIN, FOLD_OTHER, DROPPED = _fold_tables()


def fold(text: str) -> bytes:
    """A form in which misread variants of one line fall together, without white space and punctuation."""
    low = text.lower()
    out = low.encode("latin-1", "ignore")  # dashes and quotes go
    if 5 * len(out) >= 4 * len(low):
        out = out.translate(FOLD_LATIN, DROPPED)
    else:  # another script
        out = re.sub(r"[^\w@!+|]+", "", low).encode("utf-8", "surrogatepass").translate(FOLD_OTHER, DROPPED)
    for a, b in ((b"rn", b"m"), (b"ri", b"n"), (b"ti", b"n"), (b"ci", b"d"), (b"ii", b"v"), (b"vv", b"w")):
        out = out.replace(a, b)
    return out


def page_value(text: str) -> tuple[int, bool] | None:
    """(number, whether it is written as a page number and not just as a number) of a text that can be one."""
    m = PAGE_NUMBER.match(text) if len(text) < 30 else None
    if not m:
        return None
    digits = m[1].replace("l", "1").replace("I", "1").replace("o", "0").replace("O", "0")
    if digits.isdigit() and len(digits) < 8 and (any(c.isdigit() for c in m[1]) or m[1] in "lI"):
        return int(digits), bool(m[2]) or bool(re.search(r"[–—\-]|[^\W\d_]{2,}|[pPsS]\.", text.replace(m[1], " ", 1)))
    roman, total = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}, 0
    if not m[1].islower() or any(c not in roman for c in m[1]):
        return None
    values = [roman[c] for c in m[1]]
    for a, b in zip(values, [*values[1:], 0]):
        total += -a if a < b else a
    return total, True


def header_key(text: str, page: int | None, headed: bool) -> tuple[int, bool] | None:
    """(hash of the folded text without a page number at its ends, whether it is written like a sentence); None for headings and texts of few letters."""
    if headed:
        return None
    start, end = 0, len(text)
    if page is not None:
        if any(map(str.isdigit, text[:16])) and (m := HEAD_NUMBER.match(text)) and int(m[1][:9]) == page:
            start = m.end()
        if any(map(str.isdigit, text[-8:])) and (m := TAIL_NUMBER.search(text, max(start, end - 60))) and int(m[1][:9]) == page:
            end = m.start()
    key = fold(text[start:end])
    if len(key) - key.count(b"3") < 6:
        return None
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little", signed=True), len(text) > 140 or text[-1:] in ".;:,"


FEATURES = "block_id bigint, file string, ordine int, page int, page_order int, number bigint, dressed boolean, key bigint, sentence boolean, opens boolean, divided string, mark string, first string, starts int, cell boolean, heading boolean, soft boolean, pairs array<string>, misread boolean, suspects array<string>"


def features(blocks: DataFrame, bits: bytes) -> DataFrame:
    """What the later steps need of each block, without its text.

    Columns: block_id, file, ordine, page, page_order, number, dressed, key and sentence (``header_key``), opens (the text
    ends in the middle of a sentence), divided (word part before a hyphen at the end), mark (that hyphen), first (first
    word), starts (0 heading or marker, 1 lower case, 2 other), cell, heading, soft (a word is divided by a hyphen that is
    never a word's own), pairs (words divided at line ends by another), misread (a number is) and suspects (words that the
    filter of the corrections may hold).
    """
    names = [f.split()[0] for f in FEATURES.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.bool_(), pa.list_(pa.string())]

    def one(text: str, page: int | None, form, suspect: Suspects) -> tuple:
        normal = form(text)
        flat = normal.strip()
        raw = text.rstrip()
        number = page_value(flat)
        headed = bool(HEADING.match(flat))
        key = header_key(flat, page, headed) if number is None else None
        end = AT_END.search(raw[-80:]) if raw[-1:] in HYPHENS else None
        close = raw[-80:].rstrip("»”\"’')] \n")
        opens = bool(close) and (close[-1] not in ".;:!?…" or bool(OPEN_ABBREVIATION.search(close)))
        short = len(flat) < 120
        heading = short and headed
        long_words = sum(len(w) >= 2 for w in PLAIN.findall(flat)) if short else bool(LONG_WORD.search(flat))
        cell = (long_words < 3 and short and any(c.isdigit() for c in flat)) or not long_words
        starts = 0 if heading or MARKER.match(flat[:12]) else 1 if flat[:1].islower() else 2
        soft, pairs = False, []
        for m in DIVIDED.finditer(text) if "\n" in text and BROKEN.search(text) else ():
            soft |= m[2] in "\xad¬"
            if m[2] not in "\xad¬":
                pairs.append(f"{m[1]}-{m[3]}".lower())
        whole = joined_lines(text)
        found = set(TOKEN.findall(normal if whole == text else form(whole)))
        suspects, misread = suspect.among(found)
        first = PLAIN.match(flat)
        return (*(number or (None, None)), *(key or (None, None)), opens, end[1] if end else None, end[2] if end else None, first and first[0], starts, cell, heading, soft, pairs, misread, suspects)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, suspect = transducer().apply, Suspects(bits)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [one(text or "", page, form, suspect) for page, text in zip(part.column(3).to_pylist(), part.column(5).to_pylist())]
                columns = list(zip(*rows)) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([*part.columns[:5], *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    own = blocks.select("block_id", F.coalesce("file", F.lit("")).alias("file"), F.coalesce("ordine", F.lit(2**31 - 1)).alias("ordine"), "page", "page_order", "testo")
    return own.mapInArrow(run, FEATURES)


def running_headers(light: DataFrame) -> DataFrame:
    """(file, key) of lines that come back on enough pages and a large enough share of a file's pages."""
    seen = light.where("page is not null")
    pages = seen.groupBy("file").agg((F.max("page") - F.min("page") + 1).alias("pages"))
    lines = seen.where("key is not null").groupBy("file", "key", "page").agg(F.bool_and("sentence").alias("sentence")).groupBy("file", "key").agg(F.count(F.lit(1)).alias("on"), F.bool_and("sentence").alias("sentence")).where(F.col("on") >= HEADER_PAGES)
    line, sentence = F.col("on") >= HEADER_SHARE * F.col("pages"), (F.col("on") >= SENTENCE_PAGES) & (F.col("on") >= SENTENCE_SHARE * F.col("pages"))
    return lines.join(pages, "file").where(F.when(F.col("sentence"), sentence).otherwise(line)).select("file", "key")


ORDER = ("ordine", "page_order", "block_id")


def with_neighbours(rows: DataFrame, before: dict[str, Column], after: dict[str, Column], beside: DataFrame | None = None) -> DataFrame:
    """``rows`` (file, stretch, ORDER) with the last value that is not null of the rows before and the first of those after.

    Values within the stretch come from a window over it, others from one row for each stretch. ``beside`` (file,
    stretch, ...) is joined on the way.
    """
    within = Window.partitionBy("file", "stretch").orderBy(*ORDER)
    earlier, later = within.rowsBetween(Window.unboundedPreceding, -1), within.rowsBetween(1, Window.unboundedFollowing)
    place = F.struct(*ORDER)
    lasts = [F.max(F.when(c.isNotNull(), F.struct(place.alias("p"), c.alias("v")))).alias(n) for n, c in before.items()]
    firsts = [F.min(F.when(c.isNotNull(), F.struct(place.alias("p"), c.alias("v")))).alias(n) for n, c in after.items()]
    ends = rows.groupBy("file", "stretch").agg(*lasts, *firsts)
    files = Window.partitionBy("file").orderBy("stretch")
    over, under = files.rowsBetween(Window.unboundedPreceding, -1), files.rowsBetween(1, Window.unboundedFollowing)
    carried = ends.select("file", "stretch", *(F.last(n, True).over(over)["v"].alias(f"_c_{n}") for n in before), *(F.first(n, True).over(under)["v"].alias(f"_c_{n}") for n in after))
    if beside is not None:
        carried = carried.join(beside, ["file", "stretch"], "left")
    local = rows.withColumns({f"_l_{n}": F.last(c, True).over(earlier) for n, c in before.items()} | {f"_l_{n}": F.first(c, True).over(later) for n, c in after.items()})
    names = [*before, *after]
    return local.join(carried, ["file", "stretch"]).withColumns({n: F.coalesce(f"_l_{n}", f"_c_{n}") for n in names}).drop(*(f"{p}{n}" for n in names for p in ("_l_", "_c_")))


def linked(light: DataFrame, counts: DataFrame, found: DataFrame) -> DataFrame:
    """``light`` with furniture (header, page_number or null), continued, ends_divided, hyphen, misread and kept (pairs whose hyphen is their own)."""
    headers = running_headers(light).withColumn("header", F.lit(True))
    known = light.drop("suspects").join(headers, ["file", "key"], "left").withColumn("stretch", F.floor(F.col("ordine") / STRETCH))
    within = Window.partitionBy("file", "stretch").orderBy(*ORDER)
    # second deliveries stand beside the first
    rows = known.withColumn("_again", F.lag("block_id").over(within).eqNullSafe(F.col("block_id"))).where("not _again").drop("_again")
    # rows of the page before and after this one's, in the stretch and in others
    of_page = Window.partitionBy("file", "stretch", "page").orderBy(*ORDER)
    rows = rows.withColumns({"_nth": F.row_number().over(of_page), "_in": F.count(F.lit(1)).over(of_page.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    pages = rows.where("page is not null").groupBy("file", "stretch", "page").agg(F.count(F.lit(1)).alias("n"))
    of_file = Window.partitionBy("file", "page").orderBy("stretch")
    outside = pages.select("file", "stretch", "page", F.struct((F.sum("n").over(of_file) - F.col("n")).alias("above"), (F.sum("n").over(Window.partitionBy("file", "page")) - F.sum("n").over(of_file)).alias("below")).alias("x"))
    outside = outside.groupBy("file", "stretch").agg(F.map_from_entries(F.collect_list(F.struct("page", "x"))).alias("_pages"))
    rows = with_neighbours(rows, {"low": F.col("page")}, {"high": F.col("page")}, outside)
    # a page that isn't recorded lies between those of the neighbours
    low, high = F.col("low"), F.col("high")
    fits = F.when(F.col("page").isNotNull(), F.col("number") == F.col("page")).otherwise((F.col("number") >= F.coalesce(low, F.lit(0))) & (F.col("number") <= F.coalesce(high, F.lit(2**31))) & (F.col("dressed") | low.isNull() | high.isNull() | (high - low <= 2)))
    # running lines stand at the edge of their page, at most one line away from it; those written like a sentence right at it
    other = F.when(F.col("page").isNotNull(), F.try_element_at("_pages", F.col("page")))
    above, below = F.col("_nth") - 1 + F.coalesce(other["above"], F.lit(0)), F.col("_in") - F.col("_nth") + F.coalesce(other["below"], F.lit(0))
    lines = F.when(F.col("sentence"), 1).otherwise(2)
    edge = F.col("page").isNull() | (above < lines) | (below < lines)
    furniture = F.when(F.col("header") & edge, "header").when(F.col("number").isNotNull() & F.coalesce(fits, F.lit(False)), "page_number")
    rows = written(rows.withColumn("furniture", furniture).drop("_nth", "_in", "_pages", "low", "high", "header", "key", "sentence", "number", "dressed"), "furniture")
    is_body = F.col("furniture").isNull()
    body = F.when(is_body, F.struct("page", "ordine", "opens", "cell", "heading"))
    rows = with_neighbours(rows, {"last": body, "last_furniture": F.when(~is_body, F.col("ordine"))}, {"follower": F.when(is_body, F.struct("first"))})
    turned = F.when(F.col("page").isNotNull() & F.col("last.page").isNotNull(), F.col("page") != F.col("last.page")).otherwise(F.coalesce(F.col("last_furniture") > F.col("last.ordine"), F.lit(False)))
    goes_on = is_body & turned & F.col("last.opens") & ~F.col("last.cell") & ~F.col("last.heading") & (F.col("starts") > 0) & (~F.col("cell") | (F.col("starts") == 1))
    at_end = F.when(F.col("divided").isNotNull(), F.lower(F.concat_ws("-", "divided", "follower.first")))
    rows = written(rows.withColumns({"continued": F.coalesce(goes_on, F.lit(False)), "pair": at_end}).drop("last", "last_furniture", "follower", "cell", "first", "starts", "opens"), "bodies")
    wrong = light.select("block_id", F.explode("suspects").alias("word")).join(found.select("word").distinct(), "word", "left_semi").select("block_id").distinct().withColumn("_wrong", F.lit(True))
    return rows.join(own_hyphens(rows, counts), "block_id", "left").join(wrong, "block_id", "left").select(
        "block_id", "file", "stretch", "ordine", "page_order", "furniture", "continued",
        (F.col("divided").isNotNull() & (F.col("mark").isin("\xad", "¬") | ~F.coalesce("end_own", F.lit(False)))).alias("ends_divided"),
        (F.col("soft") | F.coalesce("_divided", F.lit(False)) | (F.col("divided").isNotNull() & (F.col("mark").isin("\xad", "¬") | ~F.coalesce("end_own", F.lit(False))))).alias("hyphen"),
        (F.col("misread") | F.coalesce("_wrong", F.lit(False))).alias("misread"),
        F.coalesce("kept", F.array().cast("array<string>")).alias("kept"),
    )


def own_hyphens(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """block_id, kept (divided pairs of the block whose hyphen is their own), _divided (another pair is divided by it) and end_own (the pair at the end keeps it).

    A hyphen is a word's own where the corpus has the word more often with it than without.
    """
    told = rows.select("block_id", F.explode("pairs").alias("pair"), F.lit(False).alias("end")).unionByName(rows.where("pair is not null").select("block_id", "pair", F.lit(True).alias("end")))
    distinct = told.select("pair").distinct().withColumn("one", F.regexp_replace("pair", "-", ""))
    tally = distinct.join(counts.select(F.col("word").alias("pair"), F.col("n").alias("as_pair")), "pair", "left").join(counts.select(F.col("word").alias("one"), F.col("n").alias("as_one")), "one", "left")
    judged = told.join(tally.select("pair", (F.coalesce("as_pair", F.lit(0)) > F.coalesce("as_one", F.lit(0))).alias("own")), "pair")
    return judged.groupBy("block_id").agg(F.collect_set(F.when(F.col("own"), F.col("pair"))).alias("kept"), F.bool_or(~F.col("own") & ~F.col("end")).alias("_divided"), F.bool_or(F.col("own") & F.col("end")).alias("end_own"))


def analysed(blocks: DataFrame) -> tuple[DataFrame, DataFrame, bytes]:
    """(analysis of each block, candidates of misread words, filter of those words) of scanned blocks (block_id, file, ordine, page, page_order, testo).

    Blocks delivered twice count once. Null and empty texts are cells without words; blocks without a page are placed by
    their neighbours; blocks without a place in the file come last; other columns are ignored; an empty table gives empty
    results.
    """
    counts = written(word_counts(blocks), "words")
    found = written(candidates(counts), "candidates")
    bits = word_filter(found)
    return linked(written(features(blocks, bits), "features"), counts, found), found, bits


def kinds(analysis: DataFrame) -> DataFrame:
    """(block_id, kind): header and page_number alone, else any of hyphen, misread and continued."""
    body: Column = F.array_compact(F.array(F.when(F.col("hyphen"), F.lit("hyphen")), F.when(F.col("misread"), F.lit("misread")), F.when(F.col("continued"), F.lit("continued"))))
    return analysis.select("block_id", F.explode(F.when(F.col("furniture").isNotNull(), F.array("furniture")).otherwise(body)).alias("kind")).distinct()


def occurrences(blocks: DataFrame, bits: bytes, goods: bytes) -> DataFrame:
    """Words of the filter ``bits`` in each block with the words beside them (block_id, word, left, right), and how often words of the filter ``goods`` stand beside others (left, right, n; no block_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form, suspect, ranked = transducer().apply, Suspects(bits), Suspects(goods)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows: list[tuple] = []
                beside: Counter[tuple[str, str]] = Counter()
                for block, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = TOKEN.findall(form(joined_lines(text or "")))
                    low = ["", *(t.lower() for t in found), ""]
                    for i, token in enumerate(found, 1):
                        word = suspect(token)
                        if word:
                            rows.append((block, word, low[i - 1], low[i + 1], None))
                        if ranked(low[i]):
                            beside[low[i - 1], low[i]] += 1
                            if not ranked(low[i + 1]):
                                beside[low[i], low[i + 1]] += 1
                rows += [(None, None, a, b, n) for (a, b), n in beside.items()]
                columns = list(zip(*rows)) if rows else [()] * 5
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block_id", "word", "left", "right", "n"])

    return blocks.select("block_id", "testo").mapInArrow(run, "block_id bigint, word string, left string, right string, n bigint")


def ranked_corrections(blocks: DataFrame, found: DataFrame, bits: bytes) -> DataFrame:
    """(block_id, fixes): the correction of each misread word of a block, by the words beside it (word, left, right, good).

    Of several candidates the most likely is taken: how often it occurs, how often it stands beside the neighbours, and
    how often recognition makes the confusions that it needs; ties go to the first in alphabetical order.
    """
    weights = confusion_weights(found)
    way = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
    scored = found.select("word", "good", "m", F.aggregate("ways", F.lit(0.0), lambda a, w: a + F.coalesce(F.try_element_at(way, w), F.lit(-20.0))).alias("noise"))
    several = scored.groupBy("word").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("word")
    ambiguous = scored.join(several, "word", "left_semi")
    goods = word_filter(ambiguous.select(F.col("good").alias("word")).distinct())
    seen = written(occurrences(blocks, bits, goods), "occurrences")
    beside = seen.where("n is not null").groupBy("left", "right").agg(F.sum("n").alias("n"))
    misread = seen.where("word is not null").select("block_id", "word", "left", "right").distinct()
    contexts = misread.select("word", "left", "right").distinct().join(ambiguous, "word")
    contexts = contexts.join(beside.select("left", F.col("right").alias("good"), F.col("n").alias("before")), ["left", "good"], "left").join(beside.select(F.col("left").alias("good"), "right", F.col("n").alias("after")), ["right", "good"], "left")

    def beside_it(n: str) -> Column:
        return F.ln((F.coalesce(F.col(n), F.lit(0)) + 0.01) / (F.col("m") + 1))

    likely = F.ln("m") + beside_it("before") + beside_it("after") + F.col("noise")
    best = contexts.groupBy("word", "left", "right").agg(F.min_by("good", F.struct((-likely).alias("s"), "good")).alias("good"))
    single = scored.join(several, "word", "left_anti").select("word", F.col("good").alias("only"))
    chosen = misread.join(best, ["word", "left", "right"], "left").join(single, "word", "left").select("block_id", "word", "left", "right", F.coalesce("good", "only").alias("good")).where("good is not null")
    return chosen.groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("word", "left", "right", "good"))).alias("fixes"))


def cased(good: str, token: str) -> str:
    """``good`` in the case of ``token``."""
    return good.upper() if token.isupper() and len(token) > 1 else good.capitalize() if token[0].isupper() else good


def repaired_texts(texts: DataFrame) -> DataFrame:
    """(block_id, text): one line for each block of (block_id, testo, fixes, kept), divided words joined and misread words and numbers corrected."""

    def one(text: str, fixes: list[dict], kept: list[str], form) -> str:
        own = set(kept)

        def whole(m: re.Match) -> str:
            return f"{m[1]}-{m[3]}" if m[2] in "-‐" and f"{m[1]}-{m[3]}".lower() in own else m[1] + m[3]

        ends = text.rstrip()[-1:] in HYPHENS and bool(text.strip())
        text = " ".join(form(DIVIDED.sub(whole, text) if BROKEN.search(text) else text).split())
        by_place = {(x["word"], x["left"], x["right"]): x["good"] for x in fixes}
        by_word = {x["word"]: x["good"] for x in fixes}
        if by_word or NUMERAL_INSIDE.search(text):
            low = ["", *(t.lower() for t in TOKEN.findall(text)), ""]
            at = 0

            def correct(m: re.Match) -> str:
                nonlocal at
                at += 1
                token = m[0]
                for word in (token, token.lower()):
                    if word in by_word:
                        return cased(by_place.get((word, low[at - 1], low[at + 1])) or by_word[word], token)
                return numeral(token) or token

            text = TOKEN.sub(correct, text)
        return text.rstrip(HYPHENS) + "-" if ends else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = transducer().apply
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = [one(t or "", f or [], k or [], form) for t, f, k in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=["block_id", "text"])

    return texts.select("block_id", "testo", "fixes", "kept").mapInArrow(run, "block_id bigint, text string")


def paragraphs(blocks: DataFrame) -> DataFrame:
    """file, head, blocks and text of each paragraph: repaired, without page furniture, joined over page ends.

    ``head`` is the block that starts it and ``blocks`` all of it in order. A word divided at a page end is joined.
    """
    analysis, found, bits = analysed(blocks)
    fixes = ranked_corrections(blocks, found, bits)
    body = written(analysis.where("furniture is null").select("file", "stretch", "ordine", "page_order", "block_id", "continued", "ends_divided", "kept"), "paragraphs")
    starts = F.when(~F.col("continued"), F.col("block_id"))
    heads = with_neighbours(body, {"before": starts}, {}).withColumn("head", F.coalesce(starts, "before", "block_id"))
    texts = blocks.select("block_id", "testo").dropDuplicates(["block_id"]).join(body.select("block_id", "kept"), "block_id").join(fixes, "block_id", "left")
    parts = heads.select("file", "head", "ordine", "block_id", "ends_divided").join(repaired_texts(texts), "block_id").groupBy("file", "head").agg(F.array_sort(F.collect_set(F.struct("ordine", "block_id", "text", "ends_divided"))).alias("p"))

    def add(acc: Column, x: Column) -> Column:
        text = F.when(acc["text"] == "", x["text"]).when(acc["open"], F.concat(F.regexp_replace(acc["text"], "[-‐]$", ""), x["text"])).otherwise(F.concat(acc["text"], F.lit(" "), x["text"]))
        return F.struct(text.alias("text"), x["ends_divided"].alias("open"))

    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("open"))
    return parts.select("file", "head", F.col("p.block_id").alias("blocks"), F.aggregate("p", start, add)["text"].alias("text"))
