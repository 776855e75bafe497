"""Language profiles: how headings, markers and notes look in a language.

A profile is data: words and forms of numbers in a JSON file of ``languages`` (or any file of that shape). Patterns for
both regular expression engines are made from it by a few rules: a heading is a word, a number form and perhaps a suffix.
"""

from __future__ import annotations

import hashlib
import json
import pkgutil
import re
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexstrata.functions.text import bind, lit_sql

#: Levels of structural labels (fixed values); content labels have none.
LEVELS = {"part": 1, "annex": 1, "recital": 1, "title": 2, "chapter": 3, "section": 4, "article": 5}
CONTENT_LABELS = ("paragraph", "point", "content", "unresolved", "noise")
#: Order in which headings are tried (fixed values).
ORDER = ("annex", "article", "part", "title", "chapter", "section", "recital")
#: Forms of numbers.
FORMS = {"roman": "[IVXLCDM]+(?:[.][0-9]+)?", "digits": "[0-9]+", "decimal": "[0-9]+(?:[.][0-9]+)?", "letters": "[A-Z]{1,3}", "numbered": "[0-9]+[A-Z]{0,3}", "lettered": "[0-9]+[A-Z]{0,3}(?:[.][0-9]+)?"}
#: Matches nothing, in both engines.
NEVER = r"[^\s\S]"
#: Conventions that a profile doesn't state (fixed values).
CONVENTIONS = {"rubric": "after", "rubric_words": 30, "foreign": None}
REQUIRED = ("code", "english_name", "divisions", "article", "recital", "markers", "page_words", "notes", "amending", "recital_section", "enacting", "preamble", "citations", "stopwords", "conventions", "acts")


class ProfileError(ValueError):
    """A profile that can't be used, with all its problems."""


def _any(words: list[str]) -> str:
    """One of some words or phrases; inner spaces may be longer."""
    return "(?:" + "|".join(re.sub(r"\\? ", " +", re.escape(w)).replace("\\'", "'").replace("\\-", "-") for w in sorted(words, key=lambda w: (-len(w), w))) + ")"


def _abbreviated(words: list[str]) -> str:
    """Words of headings; a full stop may follow."""
    return _any(words) + "[.]?"


@dataclass(frozen=True)
class Profile:
    """Patterns of one language; group 1 of a heading is its number, group 2 its suffix."""

    code: str
    name: str
    spec: dict
    headings: dict[str, str]
    article_rubric: str
    markers: str
    paragraph: str
    point: str
    page_number: str
    editorial: str
    amending: str
    recital_start: str
    device_start: str
    preamble: str
    citation: str
    foreign: str | None
    stopwords: tuple[str, ...]
    act_types: tuple[tuple[str, str, str, str], ...]

    def convention(self, name: str) -> object:
        """A convention of the profile, or the default one."""
        return self.spec["conventions"].get(name, CONVENTIONS[name])

    @property
    def aliases(self) -> dict[str, str]:
        return {_bare(k): v for k, v in self.spec.get("suffix_aliases", {}).items()}


def _bare(suffix: str) -> str:
    return re.sub(r"[\s-]", "", suffix.lower())


def problems(spec: dict) -> list[str]:
    """What keeps a profile from being used; nothing for a good one."""
    out = [f"{k} is missing" for k in REQUIRED if k not in spec]
    if out:
        return out
    if not re.fullmatch(r"[a-z]{2,8}", str(spec["code"])):
        out.append(f"code {spec['code']!r} is no language code")
    for label, division in spec["divisions"].items():
        if label not in LEVELS or label in ("article", "recital"):
            out.append(f"{label} is no division")
        out += [f"{label}: {form} is no form of numbers" for form in division.get("numbers", []) if form not in FORMS]
        if not division.get("words"):
            out.append(f"{label} has no words")
    if spec["conventions"].get("rubric", "after") not in ("before", "after"):
        out.append("the rubric stands before or after its number")
    out += [f"act rule {n} lacks {k}" for n, rule in enumerate(spec["acts"]) for k in ("subtype", "country", "words") if k not in rule]
    if not spec["divisions"] and not spec.get("outline"):
        out.append("no headings at all")
    return out


def _act(rule: dict) -> str:
    """Pattern of an act rule; group 1 is the number."""
    words = _any(rule["words"])
    unions = " *[(] *" + _any(rule["union"]) + "[^)]*[)]" if "union" in rule else ""
    if rule.get("union_optional"):
        unions = f"(?:{unions})?"
    number = rule.get("number")
    after = {
        "slash": unions + " *(?:no?[.]? *)?([0-9]{1,5}/[0-9]{1,5})",
        "later": "\\b(?:.*?\\bn[.]? *([0-9]{1,4}))?",
        "dated": "\\b(?: +[0-9]{1,2} +[a-z]+ +[0-9]{4} *,?)? *n[.]? *([0-9]{1,4})",
        "dash": " *(?:no[.]? *)?([0-9]{1,3} *[-–—] *[0-9]{1,4})",
        "long": " *(?:no[.]? *)?([0-9]{4,5})",
        "of_year": " +([0-9]{1,3}) +of +[0-9]{4}\\b",
        "year": " +((?:19|20)[0-9]{2})\\b",
        None: "\\b()" if rule["words"] != [""] else "()",
    }
    if number == "before":
        return f"\\b([0-9]{{1,2}}) +{words}\\b"
    start = "^ *" if rule.get("at_start") or rule["words"] == [""] else "\\b"
    return start + words + after[number]


def _phrases(texts: list[str]) -> str:
    """One of some phrases at the start of a text, in which N stands for a number."""
    ends = [re.sub(r"\\? ", " +", re.escape(t)).replace("N", "[0-9]+") + ("" if t.endswith(":") else "\\b") for t in texts]
    return "^(?:" + "|".join(ends) + ")" if ends else NEVER


def _marker(forms: list[str]) -> str:
    """Markers written like ``N. ``, ``(NA) `` or ``a) ``."""
    kinds = {"NA": "[0-9]+[A-Z]{0,2}", "N. ": "[0-9]+[0-9A-Za-z-]*[.] +", "N": "[0-9]+", "(a)": "[(](?:[a-z]{1,3}|[ivxl]{1,6})[)]", "a": "[a-z]"}
    out = []
    for form in forms:
        if form == "N. ":
            out.append(kinds[form])
        elif form.strip() == "(a)":
            out.append(kinds["(a)"] + " +")
        else:
            inner = form.strip().strip("()")
            out.append(("[(]" if form.startswith("(") else "") + kinds[inner] + ("[)]" if ")" in form else "") + " +")
    return "^(?:" + "|".join(out) + ")" if out else NEVER


def compile_profile(spec: dict) -> Profile:
    """The patterns of a profile; raises ``ProfileError`` with all problems if it has any."""
    wrong = problems(spec)
    if wrong:
        raise ProfileError("; ".join(wrong))
    suffix = f"(?: *-? *({_any(spec['suffixes'])}(?: *-? *{_any(spec['suffixes'])})?\\b))?" if spec.get("suffixes") else "()"
    headings = dict.fromkeys(ORDER, NEVER)
    for label, d in spec["divisions"].items():
        number = "|".join([*(FORMS[f] for f in d["numbers"]), *d.get("spelled", [])])
        headings[label] = f"^{_any(d['words'])} +({number}){suffix}" + ("(?:\\b|[. (]).*$" if d.get("goes_on") else "\\b")
    article = spec["article"]
    rubric = NEVER
    if article["words"]:
        letters = f"[A-Z]{{0,{article['letters']}}}" if article["letters"] else ""
        base = f"^{_abbreviated(article['words'])} *([0-9]+{letters}(?:[.][0-9]+)?){suffix}"
        headings["article"] = f"{base}(?:\\b|[.,])(?: +.{{1,{article['rubric_chars']}}})?$"
        rubric = base + "[.,]? *(.*)$"
    recital = spec["recital"]
    if recital["words"]:
        by_word = _any(recital["words"])
        headings["recital"] = f"^(?:{by_word} +[(]?([0-9]+)[)]?|[(]([0-9]+)[)] +).+" if recital["bare_number"] else f"^{by_word}\\b(?: *[:,]? *[(]?([0-9]+)[)]?)?().+"
    if outline := spec.get("outline"):
        title = f" +[A-Z][^,]{{1,{outline['most_chars']}}}$"
        for depth, label in enumerate(outline["depths"]):
            headings[label] = f"^([0-9]{{1,2}}(?:[.][0-9]{{1,2}}){{{depth}}})[.]?(){title}"
        headings[outline["depths"][0]] = f"{headings[outline['depths'][0]]}|^{_any(outline['words'])}$"
        rubric = f"^([0-9.]+)()[.]? +(.*)$"
    notes, amending = spec["notes"], spec["amending"]
    editorial = NEVER
    if notes["objects"]:
        told = " +[^ ]+ +" + _any(notes["states"]) + " +" + _any(notes["verbs"]) if notes.get("named") else " +" + _any(notes["states"])
        editorial = f"^[(][0-9]+[)] +{_abbreviated(notes['objects'])}{told}"
    amends = NEVER
    if amending["verbs"]:
        adverb = f"(?:{amending['adverb']} +)?" if amending.get("adverb") else ""
        verbs, things = "(?:" + "|".join(amending["verbs"]) + ")", "(?:" + "|".join(amending["objects"]) + ")"
        tail = f" .*{amending['tail']}" if amending.get("tail") else "\\b"
        amends = f"(?:^|[^\\p{{L}}]){_any(amending['auxiliaries'])} +{adverb}{verbs}[^\\p{{L}}].*\\b{things}{tail}"
    foreign = spec["conventions"].get("foreign")
    marks = [d["words"] for d in spec["divisions"].values()] + [article["words"]]
    return Profile(
        code=spec["code"], name=spec["english_name"], spec=spec, headings=headings, article_rubric=rubric,
        markers="\\b" + _abbreviated([w for ws in marks for w in ws if w != "§"]) + " +(?:[IVXLCDM]+\\b|[0-9])" if spec["divisions"] else NEVER,
        paragraph=_marker(spec["markers"]["paragraph"]), point=_marker(spec["markers"]["point"]),
        page_number=f"^(?:{_abbreviated(spec['page_words'])} *)?[0-9]{{1,4}}$",
        editorial=editorial, amending=amends, recital_start=_phrases(spec["recital_section"]), device_start=_phrases(spec["enacting"]), preamble=_phrases(spec["preamble"]),
        citation="\\b" + _any(spec["citations"]) if spec["citations"] else NEVER,
        foreign=f"[{foreign['letters']}]|(?:^|[^\\p{{L}}]){_any(foreign['words'])}(?:$|[^\\p{{L}}])" if foreign else None,
        stopwords=tuple(spec["stopwords"]),
        act_types=tuple((r["subtype"], r["country"], _act(r), r.get("author", "")) for r in spec["acts"]),
    )


def read_profile(path: str | Path) -> Profile:
    """A profile of a JSON file; ``ProfileError`` says what is wrong with it or that there is none."""
    try:
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError as error:
        raise ProfileError(f"there is no profile {path}") from error
    except ValueError as error:
        raise ProfileError(f"{path} is no JSON: {error}") from error
    return compile_profile(spec)


def bundled(code: str) -> Profile:
    """A profile of this package."""
    data = pkgutil.get_data(__package__, f"languages/{code}.json")
    return compile_profile(json.loads(data))


def digest(spec: dict) -> str:
    """SHA-256 of a profile's content, whatever the order of its members and where it came from."""
    own = {k: v for k, v in spec.items() if not k.startswith("_") and k not in ("detection", "source")}
    return hashlib.sha256(json.dumps(own, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def suffix_aliases(value: object) -> dict[str, str]:
    """Aliases of suffixes from any way to write them: a mapping, pairs, objects with from and to, or texts like ``a->b``; the rest is dropped."""
    found: list[tuple[object, object]] = []
    for entry in value.items() if isinstance(value, dict) else value if isinstance(value, list) else []:
        if isinstance(entry, dict) and "from" in entry and "to" in entry:
            found.append((entry["from"], entry["to"]))
        elif isinstance(entry, (list, tuple)) and len(entry) == 2:
            found.append((entry[0], entry[1]))
        elif isinstance(entry, str) and len(parts := re.split(r"->|[=:|]", entry)) == 2:
            found.append((parts[0], parts[1]))
    return {a.strip().lower(): b.strip().lower() for a, b in found if isinstance(a, str) and isinstance(b, str) and a.strip() and b.strip()}


PROFILES = {code: bundled(code) for code in ("it", "en", "paper")}
FLAGS = "(?iU)"


def matches(text: Column, pattern: str, case: bool = False) -> Column:
    """Whether the pattern is found, ignoring case."""
    return text.rlike(("(?U)" if case else FLAGS) + pattern)


def by_profile(profile: Column, make) -> Column:
    """``make`` of the row's profile; patterns stay literals, one branch for each profile."""
    out = None
    for code, p in PROFILES.items():
        out = F.when(profile == code, make(p)) if out is None else out.when(profile == code, make(p))
    return out


def by_profile_sql(profile: str, make) -> str:
    return "CASE " + " ".join(f"WHEN {profile} = '{c}' THEN {make(p)}" for c, p in PROFILES.items()) + " END"


def _re(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {lit_sql('(?i)' + pattern)})"


def editorial_note(text: Column, p: Profile) -> Column:
    """An editorial note or an instruction that amends another act."""
    return matches(text, p.editorial) | matches(text, p.amending)


def editorial_note_sql(t: str, p: Profile) -> str:
    return f"({_re(t, p.editorial)} OR {_re(t, p.amending)})"


def structural_label(text: Column, profile: Column) -> Column:
    """The label whose heading the matching text has; null for none, for empty texts and editorial notes."""

    def one(p: Profile) -> Column:
        found = F.coalesce(*(F.when(matches(text, p.headings[label]), F.lit(label)) for label in ORDER))
        return F.when((text != "") & ~editorial_note(text, p), found)

    return by_profile(profile, one)


def structural_label_sql(t: str, profile: str) -> str:
    def one(p: Profile) -> str:
        whens = " ".join(f"WHEN {_re(t, p.headings[label])} THEN '{label}'" for label in ORDER)
        return f"CASE WHEN {t} = '' OR {editorial_note_sql(t, p)} THEN NULL ELSE CASE {whens} END END"

    return by_profile_sql(profile, one)


def deterministic_label(text: Column, profile: Column, label: Column, recovered: Column) -> tuple[Column, Column]:
    """(label, reason) that the rules are sure of; null where a model has to decide.

    ``label`` is the structural label of ``text``. A recovered block is never sure.
    """

    def pick(sure: bool):
        def one(p: Profile) -> Column:
            out = F.when(label.isNotNull(), label if sure else F.lit("structural_header"))
            out = out.when(matches(text, p.page_number), "noise" if sure else "page_number")
            out = out.when(matches(F.concat(text, F.lit(" ")), p.paragraph), "paragraph" if sure else "paragraph_marker")
            return out.when(matches(F.concat(text, F.lit(" ")), p.point), "point" if sure else "point_marker")

        return F.when(~F.coalesce(recovered, F.lit(False)), by_profile(profile, one))

    return pick(True), pick(False)


def deterministic_label_sql(t: str, profile: str, label: str, recovered: str, sure: bool) -> str:
    def one(p: Profile) -> str:
        values = ("noise", "paragraph", "point") if sure else ("page_number", "paragraph_marker", "point_marker")
        first = label if sure else "'structural_header'"
        return f"CASE WHEN {label} IS NOT NULL THEN {first} WHEN {_re(t, p.page_number)} THEN '{values[0]}' WHEN {_re(f'({t} || chr(32))', p.paragraph)} THEN '{values[1]}' WHEN {_re(f'({t} || chr(32))', p.point)} THEN '{values[2]}' END"

    return f"CASE WHEN coalesce({recovered}, false) THEN NULL ELSE {by_profile_sql(profile, one)} END"


def structural_number(text: Column, profile: Column, label: Column) -> Column:
    """The number of a heading: roman numerals in upper case, others lower, ``-suffix`` added."""

    def one(p: Profile) -> Column:
        def of(k: int) -> Column:
            return F.coalesce(*(F.when(label == x, F.regexp_extract(text, FLAGS + p.headings[x], k)) for x in ORDER))

        def shown(g: Column) -> Column:
            first, second = F.nullif(g[0], F.lit("")), F.nullif(g[1], F.lit(""))
            base = F.when(label == "recital", F.coalesce(first, second)).otherwise(first)
            number = F.when(matches(base, "^[ivxlcdm]+(?:[.][0-9]+)?$"), F.upper(base)).otherwise(F.lower(base))
            plain = F.regexp_replace(F.lower(second), r"[\s-]", "")
            known = F.coalesce(*(F.when(plain == k, F.lit(v)) for k, v in p.aliases.items()), plain) if p.aliases else plain
            suffix = F.when(label != "recital", known)
            return F.when(suffix.isNotNull(), F.concat(number, F.lit("-"), suffix)).otherwise(number)

        return bind(F.array(of(1), of(2)), shown)

    return by_profile(profile, one)


def structural_number_sql(t: str, profile: str, label: str) -> str:
    def one(p: Profile) -> str:
        def of(k: int) -> str:
            return "nullif(CASE " + " ".join(f"WHEN {label} = '{x}' THEN regexp_extract({t}, {lit_sql('(?i)' + p.headings[x])}, {k})" for x in ORDER) + " END, '')"

        base = f"CASE WHEN {label} = 'recital' THEN coalesce({of(1)}, {of(2)}) ELSE {of(1)} END"
        shown = f"CASE WHEN {_re(base, '^[ivxlcdm]+(?:[.][0-9]+)?$')} THEN upper({base}) ELSE lower({base}) END"
        plain = f"regexp_replace(lower({of(2)}), '[\\s-]', '', 'g')"
        known = f"CASE {plain} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in p.aliases.items()) + f" ELSE {plain} END" if p.aliases else plain
        suffix = f"CASE WHEN {label} <> 'recital' THEN {known} END"
        return f"CASE WHEN {suffix} IS NOT NULL THEN {shown} || '-' || {suffix} ELSE {shown} END"

    return by_profile_sql(profile, one)


def article_rubric(text: Column, profile: Column) -> Column:
    """What follows the number of an article heading, without punctuation around it; null where nothing does."""
    return by_profile(profile, lambda p: F.nullif(F.regexp_replace(F.regexp_extract(text, FLAGS + p.article_rubric, 3), r"^[ .;:\-]+|[ .;:\-]+$", ""), F.lit("")))


def article_rubric_sql(t: str, profile: str) -> str:
    return by_profile_sql(profile, lambda p: f"nullif(regexp_replace(regexp_extract({t}, {lit_sql('(?i)' + p.article_rubric)}, 3), '^[ .;:\\-]+|[ .;:\\-]+$', '', 'g'), '')")


#: The profile of a file by its language label: English where it names English, else the default.
ENGLISH = "^(?:en|eng|english|inglese)(?:[^a-z]|$)"


def profile_of(code: Column) -> Column:
    return F.when(F.lower(F.trim(F.coalesce(code, F.lit("")))).rlike(ENGLISH), "en").otherwise("it")


def profile_of_sql(code: str) -> str:
    return f"CASE WHEN regexp_matches(lower(trim(coalesce({code}, ''))), '{ENGLISH}') THEN 'en' ELSE 'it' END"


