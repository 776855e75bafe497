"""Legislative XML of a document's tree: sections, hierarchy, points under paragraphs, recitals, attachments, ids and checks.

The decisions of the tree are taken before, over all documents at once; here one document is put together, which is the
unit of the sink. The parts of a document don't depend on each other's text, so rows carry no more than they need.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame

from lexstrata.functions import profiles as P
from lexstrata.operators.export import NAMESPACE, PREFIX

#: Elements of the hierarchy and those that hold blocks without a content element around them (fixed values).
HIERARCHY = ("part", "title", "chapter", "section", "article")
BARE = ("preface", "preamble", "recital", "citation", "recitals", "mainBody", "intro", "wrapUp", "content")


@dataclass
class Element:
    """One element with its text before, in and after its children."""

    tag: str
    eid: str | None = None
    attrs: dict[str, str] = field(default_factory=dict)
    num: str | None = None
    heading: str | None = None
    intro: list[str] = field(default_factory=list)
    content: list[str] = field(default_factory=list)
    wrap: list[str] = field(default_factory=list)
    children: list[Element] = field(default_factory=list)

    def say(self, text: str) -> None:
        """Adds a text: after the children if there are any."""
        (self.wrap if self.children else self.content).append(text)

    def hang(self, child: Element) -> Element:
        """Adds a child; text that was the content so far introduces it."""
        self.intro += self.content
        self.content = []
        self.children.append(child)
        return child

    def walk(self) -> Iterator[Element]:
        yield self
        for c in self.children:
            yield from c.walk()


class Ids:
    """Element ids: prefix and number (or place), below the parent's; repeated ones get _2, _3."""

    def __init__(self) -> None:
        self.used: Counter[str] = Counter()

    def of(self, label: str, number: str | None, parent: str | None, place: int) -> str:
        token = re.sub(r"[^0-9A-Za-z]+", "-", number or "").strip("-") or str(place)
        base = (f"{parent}__" if parent else "") + f"{PREFIX.get(label, label)}_{token}"
        eid = base
        while eid in self.used:
            self.used[base] += 1
            eid = f"{base}_{self.used[base]}"
        self.used[eid] = 1
        return eid


def _marker(text: str, profile: str) -> tuple[str, str, str]:
    """(kind, marker as printed, text behind it)."""
    p = P.PROFILES[profile if profile in P.PROFILES else "it"]
    for kind, pattern in (("paragraph", p.paragraph), ("point", p.point)):
        if pattern != P.NEVER and (m := re.match(pattern, text, re.I)):
            return kind, m[0].strip(), text[m.end() :].strip()
    return "content", "", text


def _structured(owner: Element, texts: list[str], profile: str, ids: Ids) -> None:
    """Hangs contents below their owner: points under the paragraph before them, other text to the open point, paragraph or last child."""
    paragraph = point = None
    for text in texts:
        kind, mark, rest = _marker(text, profile)
        if kind == "content":
            (point or paragraph or (owner.children[-1] if owner.children else owner)).say(text)
            continue
        above = owner if kind == "paragraph" or paragraph is None else paragraph
        child = Element(kind, ids.of(kind, mark, above.eid, len(above.children) + 1), num=mark, content=[rest] if rest else [])
        above.hang(child)
        paragraph, point = (child, None) if kind == "paragraph" else (paragraph, child)


def build(rows: list[dict], uri: str, language: str, profile: str) -> Element:
    """The document of ``rows`` in reading order: seq, label, level (null for contents), number, rubric, norm, parent_seq, owner_seq."""
    ids, act = Ids(), Element("act", attrs={"name": "act"})
    preface, preamble, body, attachments = Element("preface"), Element("preamble"), Element("body"), Element("attachments")
    p = P.PROFILES[profile if profile in P.PROFILES else "it"]
    contents: dict[int | None, list[str]] = {}
    for r in rows:
        if r["level"] is None:
            contents.setdefault(r["owner_seq"], []).append(r["norm"])
    places: Counter[int | None] = Counter()
    made: dict[int, Element] = {}
    recitals = Element("recitals")
    for r in rows:
        if r["level"] is None:
            continue
        own, label = contents.get(r["seq"], []), r["label"]
        places[r["parent_seq"]] += 1
        if label == "recital":
            rest = re.sub(r"^[(]?\s*[0-9]*\s*[)]?\s*", "", r["norm"])
            recitals.hang(Element("recital", ids.of("recital", r["number"], None, len(recitals.children) + 1), num=f"({r['number']})" if r["number"] else None, content=[rest, *own]))
            continue
        above = made.get(r["parent_seq"])
        annex = label == "annex"
        tag = "attachment" if annex else label if label in HIERARCHY else "hcontainer"
        element = Element(tag, ids.of(label, r["number"], above.eid if above else None, places[r["parent_seq"]]), num=r["norm"] if label != "article" or not r["rubric"] else r["norm"].split(r["rubric"])[0].strip(" .-") or r["norm"], heading=r["rubric"])
        if annex:
            inner = Element("mainBody", heading=None)
            element.attrs, element.heading, element.num = {"name": "annex"}, r["norm"], None
            element.children.append(inner)
            _structured(inner, own, profile, ids)
            made[r["seq"]] = inner
            inner.eid = element.eid
            attachments.children.append(element)
        else:
            (above or body).hang(element)
            _structured(element, own, profile, ids)
            made[r["seq"]] = element
    for text in contents.get(None, []):
        if re.search(p.recital_start, text, re.I):
            recitals.intro.append(text)
        elif re.search(p.preamble, text, re.I):
            preamble.children.append(Element("citation", ids.of("citation", None, None, len(preamble.children) + 1), content=[text]))
        elif made or recitals.children:
            preface.say(text)
        else:
            body.say(text)
    if recitals.children or recitals.intro:
        preamble.children.append(recitals)
    if not body.children:
        body.children.append(Element("hcontainer", "hcontainer_1", {"name": "content"}, content=body.content or [""]))
        body.content = []
    act.children = [Element("meta", attrs={"uri": uri, "language": language}), *(s for s in (preface, preamble) if s.children or s.content), body, *([attachments] if attachments.children else [])]
    return act


def _text(texts: list[str]) -> str:
    return "".join("<p>" + escape("".join(c for c in t if c >= " " or c in "\t\n")) + "</p>" for t in texts)


def _meta(uri: str, language: str) -> str:
    work = f"<FRBRWork><FRBRthis value={quoteattr(uri + '/!main')}/><FRBRuri value={quoteattr(uri)}/></FRBRWork>"
    expression = f"<FRBRExpression><FRBRthis value={quoteattr(f'{uri}/{language}@/!main')}/><FRBRuri value={quoteattr(f'{uri}/{language}@')}/><FRBRlanguage language={quoteattr(language)}/></FRBRExpression>"
    return f'<meta><identification source="#engine">{work}{expression}<FRBRManifestation><FRBRthis value={quoteattr(f"{uri}/{language}@/!main.xml")}/><FRBRuri value={quoteattr(f"{uri}/{language}@.xml")}/></FRBRManifestation></identification></meta>'


def to_xml(e: Element, uri: str, language: str) -> str:
    """An element as text: attributes, number, heading, text before, children, text after, content."""
    if e.tag == "meta":
        return _meta(uri, language)
    attrs = (f" eId={quoteattr(e.eid)}" if e.eid and e.tag != "mainBody" else "") + "".join(f" {k}={quoteattr(v)}" for k, v in e.attrs.items() if e.tag != "attachment")
    head = (f"<num>{escape(e.num)}</num>" if e.num else "") + (f"<heading>{escape(e.heading)}</heading>" if e.heading else "")
    bare = e.tag in BARE
    before = _text(e.intro) if bare else f"<intro>{_text(e.intro)}</intro>" if e.intro else ""
    after = _text(e.wrap) if bare else f"<wrapUp>{_text(e.wrap)}</wrapUp>" if e.wrap else ""
    inside = _text(e.content) if bare else f"<content>{_text(e.content)}</content>" if e.content else ""
    inner = "".join(to_xml(c, uri, language) for c in e.children)
    if e.tag == "attachment":
        return f"<attachment{attrs}>{head}<doc name=\"annex\">{_meta(f'{uri}/!{e.eid}', language)}{inner}</doc></attachment>"
    return f"<{e.tag}{attrs}>{head}{before}{inner}{after}{inside}</{e.tag}>"


def check(act: Element) -> dict[str, object]:
    """Elements, ids, repeated ids, elements with content beside children, and whether the body is empty; valid without any of these faults."""
    every = list(act.walk())
    ids = Counter(e.eid for e in every if e.eid and e.tag != "mainBody")
    repeated, mixed = sum(n > 1 for n in ids.values()), sum(bool(e.content and e.children) for e in every if e.tag not in BARE)
    empty = not any(e.children for e in every if e.tag == "body")
    return {"elements": len(every), "eids": len(ids), "repeated": repeated, "mixed": mixed, "empty_body": empty, "valid": not (repeated or mixed or empty)}


def documents(rows: DataFrame) -> DataFrame:
    """file, xml, elements, eids, repeated, mixed, empty_body and valid of each document.

    ``rows``: file, profile, uri, language, seq, label, level, number, rubric, norm, parent_seq, owner_seq.
    """

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seq")
        head = group.iloc[0]
        clean = group.astype(object).where(group.notna(), None).to_dict("records")
        act = build(clean, head["uri"], head["language"], head["profile"])
        xml = f'<?xml version="1.0" encoding="UTF-8"?>\n<akomaNtoso xmlns="{NAMESPACE}">{to_xml(act, head["uri"], head["language"])}</akomaNtoso>'
        return pd.DataFrame([{"file": head["file"], "xml": xml, **check(act)}])

    return rows.groupBy("file").applyInPandas(one, "file string, xml string, elements bigint, eids bigint, repeated bigint, mixed bigint, empty_body boolean, valid boolean")
