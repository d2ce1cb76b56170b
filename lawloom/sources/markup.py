"""Volumes of markup as rows: one streaming parse, one rule table for all row-producing paths.

A law's body is walked once. The rules name the container elements that may hold sections and appropriations and the
column each one's label goes to; every combination of nesting is covered by the recursion, so no path is lost. With
``strict`` only the combinations in STRICT_PATHS give rows.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.parsers import expat

from lawloom.schemas import RAW_FIELDS

# Element names of the markup.
SKIPPED = frozenset({"sidenote", "page", "approvedDate", "footnote"})
HEADINGS = frozenset({"heading", "subheading"})
OUTLINE = frozenset({"section", "subsection", "paragraph", "subparagraph", "clause", "subclause", "chapter", "subchapter", "item", "level"})
#: Containers, and the column that their label goes to. Parts and levels have none.
CONTAINERS = {"division": "Division", "title": "Title", "subtitle": "SubTitle", "chapter": "Chapter", "subchapter": "SubChapter", "part": None, "level": None}
RECOVERED_FROM = ("part", "title", "chapter")
NESTED = ("part", "title", "chapter", "subchapter", "subtitle", "level")
#: Container paths, from the body down, whose sections or appropriations strict mode gives.
STRICT_PATHS = {
    "section": {"", "level", "title/level", "title", "title/chapter/level", "title/chapter", "title/part/chapter/level", "title/part/chapter", "title/subtitle/level", "title/subtitle", "division", "division/title/subtitle/level", "division/title/subtitle", "division/title/level", "division/title"},
    "appropriations": {"", "title/chapter", "title/part/chapter", "title", "division/title"},
}
#: Laws with a shape of their own: (volume, identifier) -> how their body is read.
SPECIAL = {
    (75, "87-292"): "ordinals",
    (75, "87-356"): "ordinals",
    (75, "87-195"): "parts",
    (75, "87-328"): "parts",
    (75, "87-397"): "subsections",
    (78, "88-643"): "title_parts",
}
#: A section number that its law prints otherwise: (identifier, path) -> number.
NUMBER_OVERRIDES = {("81-207", "title/part/chapter"): "576."}


def name_of(elem) -> str:
    return elem.tag.rpartition("}")[2] if isinstance(elem.tag, str) else ""


def children(elem, *names: str) -> list:
    return [c for c in elem if name_of(c) in names]


def child(elem, name: str):
    return next((c for c in elem if name_of(c) == name), None)


def descendant(elem, name: str):
    return next((c for c in elem.iter() if c is not elem and name_of(c) == name), None)


def clean_text(elem, *, skip: frozenset = SKIPPED, tail: bool = True) -> str:
    """All text below an element but that of skipped ones; what follows those, and the element itself, is kept."""
    if elem is None:
        return ""
    out: list[str] = []

    def walk(e, with_tail: bool) -> None:
        if name_of(e) not in skip:
            out.append(e.text or "")
            for c in e:
                walk(c, True)
        if with_tail:
            out.append(e.tail or "")

    walk(elem, tail)
    return "".join(out)


def label(elem) -> str:
    return (clean_text(child(elem, "num")) + clean_text(child(elem, "heading"))).strip()


def outline_text(section) -> str:
    """Indented lines of a section: each part's number, heading and lead-in or content, below its parent's."""

    def lines(e, depth: int) -> Iterator[str]:
        top, name, indent = name_of(e) == "section", name_of(e), "    " * depth
        head = "" if top else clean_text(child(e, "num")) + clean_text(child(e, "heading"))
        lead, content = child(e, "chapeau"), child(e, "content")
        if lead is not None:
            yield indent + head + clean_text(lead)
        if content is not None:
            yield clean_text(content) if name == "appropriations" else indent + head + clean_text(content)
        elif not top and lead is None:
            yield indent + head
        for c in e:
            if name_of(c) in OUTLINE:
                below = "\n".join(filter(None, lines(c, depth + 1)))
                if below:
                    after = "".join(" " + clean_text(x) for x in children(c, "continuation"))
                    yield f"{below} {after}"

    return "\n".join(filter(None, lines(section, 0))).strip()


@dataclass
class Law:
    """A law's metadata and rows."""

    vol: int
    xml_index: int
    meta: dict
    rows: list[dict] = field(default_factory=list)

    def add(self, kind: str, **values) -> None:
        row = dict.fromkeys(RAW_FIELDS)
        row |= {"approvedDate": self.meta["approved_date"], "LawTitle": self.meta["official_title"], "LawType": self.meta["doc_title"], "LawIdentifier": self.meta["law_id"], "counter": len(self.rows)}
        self.rows.append(row | values | {"EntryType": kind})


def _trimmed(text: str | None, trim: bool) -> str | None:
    return text.strip() if trim and text is not None else text


class Walker:
    """Rows of law bodies. number_rules gives a section's corrected number or None.

    compat keeps to the known paths and also repeats what stands right below a division's title once for each chapter of
    that title, under that chapter's label, as older tables do.
    """

    def __init__(self, *, strict: bool = False, trim: bool = True, number_rules=None, compat: bool = False):
        self.strict, self.trim, self.number_rules, self.compat = strict or compat, trim, number_rules, compat

    def law(self, elem, vol: int, xml_index: int, meta: dict) -> Law:
        law = Law(vol, xml_index, meta)
        body = child(elem, "main")
        if body is None:
            return law
        special = SPECIAL.get((vol, _short(meta["law_id"])))
        if special:
            getattr(self, f"_{special}")(law, body)
        else:
            self._container(law, body, "", {})
            if not law.rows:
                self._recover(law, body)
        return law

    def _section(self, law: Law, section, path: str, labels: dict, **more) -> None:
        num, heading, text = child(section, "num"), child(section, "heading"), outline_text(section)
        name = clean_text(heading) if heading is not None else None
        number = clean_text(num) if num is not None else None
        fixed = self.number_rules(law.meta["law_id"], name or "", text) if self.number_rules else None
        number = fixed or NUMBER_OVERRIDES.get((_short(law.meta["law_id"]), path)) or number
        law.add("Section", **labels, **({"SectionNumber": _trimmed(number, self.trim), "SectionName": _trimmed(name, self.trim), "Text": text or None} | more))

    def _block(self, law: Law, block, labels: dict, above: list[str | None]) -> None:
        """The deepest blocks of nested appropriations, with the headings of all above them."""
        heading = child(block, "heading")
        own = None if heading is None else f"{clean_text(heading)} {''.join(clean_text(s) for s in children(block, 'subheading'))}".strip()
        levels = [*above, own]
        inner = children(block, "appropriations")
        if inner and len(levels) < 3:
            for b in inner:
                self._block(law, b, labels, levels)
            return
        content = child(block, "content")
        text = clean_text(content) if content is not None and len(content) else clean_text(block, skip=SKIPPED | HEADINGS)
        law.add("Division", **labels, Text=text, **{f"DivisionHeadingLevel{n + 1}": x for n, x in enumerate(levels)})

    def _container(self, law: Law, elem, path: str, labels: dict) -> None:
        open_ = lambda kind: not self.strict or path in STRICT_PATHS[kind]
        if open_("section"):
            for s in children(elem, "section"):
                self._section(law, s, path, labels)
        if open_("appropriations"):
            for b in children(elem, "appropriations"):
                self._block(law, b, labels, [])
        for c in elem:
            kind = name_of(c)
            if kind in CONTAINERS and not (path == "" and kind in ("part", "chapter")):
                column = CONTAINERS[kind]
                num = child(c, "num")
                text = None if num is None else clean_text(num) if kind == "division" else num.text
                self._container(law, c, f"{path}/{kind}".strip("/"), labels | ({column: _trimmed(text, self.trim)} if column else {}))
        if self.compat and path == "division/title":
            self._repeated(law, elem, path, labels)

    def _repeated(self, law: Law, title, path: str, labels: dict) -> None:
        for chapter in [*children(title, "chapter"), *(c for p in children(title, "part") for c in children(p, "chapter"))]:
            num = child(chapter, "num")
            own = labels | {"Chapter": None if num is None else _trimmed(num.text, self.trim)}
            for s in [*(s for x in children(title, "level") for s in children(x, "section")), *children(title, "section")]:
                self._section(law, s, path, own)
            for b in children(title, "appropriations"):
                self._block(law, b, own, [])

    # Bodies that gave no row otherwise.

    def _recover(self, law: Law, body) -> None:
        for kind in RECOVERED_FROM:
            for c in children(body, kind):
                before = len(law.rows)
                self._nested(law, c, [label(c) or None])
                if len(law.rows) == before:
                    for b in children(c, "appropriations"):
                        self._recovered_block(law, b, [label(c) or None])
        if law.rows:
            return
        for texts in ([outline_text(s) for s in children(body, "subsection")], [clean_text(q).strip() for q in children(body, "quotedContent")], [self._bare(body)]):
            if any(texts):
                law.add("Section", SectionNumber="1", Text="\n".join(filter(None, texts)) or None)
                return

    def _nested(self, law: Law, elem, labels: list[str | None]) -> None:
        columns = {f"DivisionHeadingLevel{n + 1}": x for n, x in enumerate(labels[:3])}
        for s in children(elem, "section"):
            self._section(law, s, "", columns)
        for kind in NESTED:
            for c in children(elem, kind):
                self._nested(law, c, [*labels, label(c) or None][:3])

    def _recovered_block(self, law: Law, block, above: list[str | None]) -> None:
        inner = children(block, "appropriations")
        if inner and len(above) < 3:
            for b in inner:
                self._recovered_block(law, b, [*above, clean_text(child(block, "heading")).strip() or None])
            return
        levels = above if len(above) == 3 else [*above, clean_text(child(block, "heading")).strip() or None][: 2 if len(above) == 1 else len(above)]
        content = child(block, "content")
        text = clean_text(content) if content is not None else clean_text(block, skip=SKIPPED | HEADINGS)
        law.add("Section", Text=text.strip() or None, **{f"DivisionHeadingLevel{n + 1}": x for n, x in enumerate(levels)})

    @staticmethod
    def _bare(body) -> str:
        return "\n".join(filter(None, (clean_text(c, tail=False).strip() for c in children(body, "p", "content"))))

    # Laws with a shape of their own.

    def _ordinals(self, law: Law, body) -> None:
        for n, s in enumerate(children(body, "section"), 1):
            self._section(law, s, "", {}, SectionNumber=str(n), Text=outline_text(s) or clean_text(s).strip() or None)

    def _parts(self, law: Law, body) -> None:
        for p in children(body, "part"):
            for s in children(p, "section"):
                self._section(law, s, "", {"DivisionHeadingLevel1": label(p) or None})

    def _title_parts(self, law: Law, body) -> None:
        for t in children(body, "title"):
            for p in children(t, "part"):
                for s in children(p, "section"):
                    self._section(law, s, "", {"DivisionHeadingLevel1": label(t) or None, "DivisionHeadingLevel2": label(p) or None})

    def _subsections(self, law: Law, body) -> None:
        texts = [outline_text(s) for s in children(body, "subsection")]
        law.add("Section", SectionNumber="1", Text="\n".join(filter(None, texts)) or None)


def _short(law_id: str) -> str:
    m = re.search(r"(\d+)\s*[–—\-]\s*(\d+)", law_id or "")
    return f"{m[1]}-{m[2]}" if m else ""


def text_of(elem) -> str | None:
    return None if elem is None else "".join(elem.itertext()).strip()


@dataclass
class Place:
    """Where a law stands in its file."""

    first_line: int
    last_line: int
    path: str


def places(content: bytes) -> list[Place]:
    """Lines and ancestors of every law, in the order of their start tags."""
    out: list[Place] = []
    stack: list[str] = []
    open_: list[int] = []
    p = expat.ParserCreate()

    def start(tag, _):
        tag = tag.rpartition(":")[2]
        stack.append(tag)
        if tag == "pLaw":
            open_.append(len(out))
            out.append(Place(p.CurrentLineNumber, p.CurrentLineNumber, "/".join(stack)))

    def end(tag):
        stack.pop()
        if tag.rpartition(":")[2] == "pLaw":
            out[open_.pop()].last_line = p.CurrentLineNumber

    p.StartElementHandler, p.EndElementHandler = start, end
    p.Parse(content, True)
    return out


def laws(content: bytes) -> Iterator[tuple[int, object]]:
    """(index, element) of each law; an element's memory is given back before the next one is read."""
    n, depth = 0, 0
    for event, e in ET.iterparse(io.BytesIO(content), ("start", "end")):
        if name_of(e) == "pLaw":
            depth += 1 if event == "start" else -1
            if event == "end" and not depth:
                yield n, e
                n += 1
                e.clear()


def metadata(elem) -> dict:
    cites = [text_of(c) or "" for c in elem.iter() if name_of(c) == "citableAs"]
    get = lambda name: text_of(descendant(elem, name))
    return {
        "public_private": get("publicPrivate"),
        "citable_as": cites[0] if cites else None,
        "statutes_citation": next((c for c in cites if " Stat. " in c), None),
        "sidenote": get("sidenote"),
        "congress": get("congress"),
        "session": get("session"),
        "doc_number": get("docNumber"),
        "approved_date": get("approvedDate"),
        "official_title": clean_text(descendant(elem, "officialTitle"), tail=False).strip(),
        "doc_title": clean_text(descendant(elem, "docTitle"), tail=False).strip(),
    }
