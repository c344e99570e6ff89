"""Line by line versions of the folds, in plain Python, to hold the Columns against."""

from __future__ import annotations

import re

import pandas as pd

from pagewright.functions.vocabulary import BULLET_CHARS

_SPACES = re.compile(r"\s+")


def _squeeze(text: str) -> str:
    return _SPACES.sub(" ", text).strip()


def _kind(line: dict) -> str:
    """What a line is by its marker, font, place and beginning."""
    text, font, x0 = line["text"], line["fontname"], line["x0"]
    if line.get("marker_type"):
        return "tagged"
    if "SymbolMT" in font and text.strip() in BULLET_CHARS:
        return "bullet"
    if x0 <= 80 and text[:1] in ("\u2022", "\uf0b7", "\uf0a7", "\u2023") and text and "SymbolMT" not in font and "Wingdings" not in font:
        return "own_bullet"
    if "Courier" in font and text.strip() == "o":
        return "sub_bullet"
    if "Wingdings" in font:
        return "sub_sub"
    if text.startswith(("Note:", "Note :")):
        return "note"
    if x0 <= 65 and re.match(r"\d+\.", text):
        return "num"
    if 85 <= x0 <= 100 and re.match(r"[ivxIVX]+\.\s", text):
        return "roman"
    if 68 <= x0 <= 78 and re.match(r"[A-E]\)", text):
        return "letter"
    return "plain"


MARKS = ("®", "™")
_MARKER_KIND = {"bullet": "bullet", "sub_bullet": "sub_bullet", "sub_sub_bullet": "sub_sub"}
_MARKERS = {"tagged", "bullet", "own_bullet", "sub_bullet", "sub_sub"}
#: Where a marker without text of its own looks for it: neighbours by distance, the nearer page side first.
CLAIMS = {"bullet": (1, -1), "sub_bullet": (-1, 1), "sub_sub": (1, -1)}
REACH, MARK_REACH = 8, 15


class _Block:
    """Lines of a block, and which of them are taken by others."""

    def __init__(self, lines: list[dict]):
        self.lines, self.kinds, self.taken = lines, [_kind(x) for x in lines], set()

    def claim(self, i: int, order: tuple[int, ...], reach: float) -> str:
        """Text of the first neighbour within reach that is free; a tagged line takes all but tagged ones, other markers take no line with a marker."""
        barred = {"tagged"} if self.kinds[i] == "tagged" else _MARKERS
        top = self.lines[i]["top"]
        free = (j for j in (i + k for k in order) if 0 <= j < len(self.lines) and j not in self.taken and self.kinds[j] not in barred and abs(self.lines[j]["top"] - top) <= reach)
        j = next(free, None)
        if j is None:
            return ""
        self.taken.add(j)
        return self.lines[j]["text"]

    def marked(self, i: int) -> tuple[str, str]:
        """Kind and text of a line with a marker: its own text, or that of a neighbour; a trademark takes what follows it."""
        kind, text = self.kinds[i], self.lines[i]["text"]
        shown = _MARKER_KIND[self.lines[i]["marker_type"]] if kind == "tagged" else "bullet" if kind == "own_bullet" else kind
        if kind == "own_bullet":
            text = text.lstrip("• ").strip()
        elif kind != "tagged" or not text:
            text = self.claim(i, CLAIMS[shown], REACH)
        if kind in ("tagged", "own_bullet") and text.strip() in (MARKS if kind == "tagged" else (*MARKS, "")):
            text = text.strip() + self.claim(i, (1,), MARK_REACH)
            text = text.strip() if kind == "own_bullet" else text
        return shown, text

    def note(self, i: int) -> str:
        """A note with the plain lines after it; those that number themselves begin a line."""
        text = self.lines[i]["text"]
        for j in range(i + 1, len(self.lines)):
            line = self.lines[j]
            if j in self.taken and self.kinds[j] != "tagged":
                continue
            if self.kinds[j] != "plain" or line.get("bold") or line.get("size", 0) >= 12 or line.get("in_table"):
                if self.kinds[j] == "tagged" and j in self.taken:
                    continue
                break
            more = line["text"].strip()
            text = f"{text}<br>{more}" if re.match(r"\d+[)]", more) else _squeeze(f"{text} {more}")
            self.taken.add(j)
        return text


def resolve_markers(lines: list[dict]) -> list[tuple[int, float, str, str, float]]:
    """(page, top, kind, text, x0) of a block's entries: markers with the text they claim, notes with the lines they take in."""
    block = _Block(lines)
    entries = []
    for i, (line, kind) in enumerate(zip(lines, block.kinds)):
        if kind == "plain":
            continue
        shown, text = block.marked(i) if kind in _MARKERS else (kind, block.note(i) if kind == "note" else line["text"])
        entries.append((line["page"], line["top"], shown, text, line["x0"]))
    entries += [(x["page"], x["top"], "plain", x["text"], x["x0"]) for i, x in enumerate(lines) if block.kinds[i] == "plain" and i not in block.taken]
    return sorted(entries, key=lambda e: e[:2])


LEVELS = ("bullet", "sub", "num", "letter", "roman", "note")
#: What an entry of a kind does. closes: levels that end before it. places: the first of these that is open takes it, as (level
#: above, kind there, level it opens, levels it ends); a level above of None is the block itself. alone: the level that a plain
#: item opens where no place is.
RULES: dict[str, dict] = {
    "bullet": {"closes": LEVELS, "places": [(None, "bullet", "bullet", ())], "alone": None},
    "num": {"closes": LEVELS, "places": [(None, "num", "num", ())], "alone": None},
    "sub_bullet": {"closes": ("roman", "note"), "places": [("bullet", "sub_bullet", "sub", ())], "alone": None},
    "sub_sub": {"closes": ("roman", "note"), "places": [("sub", "sub_sub", None, ()), ("bullet", "sub_bullet", None, ())], "alone": None},
    "letter": {"closes": ("roman", "note"), "places": [("num", "letter", "letter", ())], "alone": "letter"},
    "roman": {"closes": ("note",), "places": [("letter", "roman", "roman", ()), ("last of num", "roman", "roman", ())], "alone": "roman"},
    "note": {"closes": (), "places": [("roman", "note", "note", ("roman",)), ("beside num", "note", "note", ()), ("beside letter", "note", "note", ())], "alone": "note"},
}
#: Levels that a plain line goes on in, the first that is open.
GOES_ON = ("roman", "note", "sub", "bullet", "num")
_LOST = -1


class _Tree:
    """Items under construction, and which of each level is open."""

    def __init__(self, compat: bool):
        self.items: list[list] = []  # parent, kind, text
        self.open: dict[str, int] = {}
        self.bullet_at = (0, 0.0)
        self.compat = compat

    def add(self, kind: str, text: str, parent: int = -1) -> int:
        self.items.append([parent, kind, text])
        return len(self.items) - 1

    def under(self, level: str | None) -> int | None:
        """The item that a place names; -1 for the block, None if it isn't open."""
        if level is None:
            return -1
        if level.startswith("beside "):
            return -1 if level[7:] in self.open else None
        if level.startswith("last of "):
            of = self.open.get(level[8:])
            return None if of is None else next((i for i in range(len(self.items) - 1, -1, -1) if self.items[i][0] == of), None)
        return self.open.get(level)

    def enter(self, kind: str, text: str) -> None:
        rule = RULES[kind]
        for level in rule["closes"]:
            self.open.pop(level, None)
        found = next(((p, *place[1:]) for place in rule["places"] if (p := self.under(place[0])) is not None), None)
        parent, shown, opens, ends = found or (-1, "plain", rule["alone"], ())
        new = self.add(shown, text, parent)
        for level in ends:
            self.open.pop(level, None)
        if opens:
            self.open[opens] = _LOST if found is None and kind == "note" and self.compat else new

    def plain(self, text: str, page: int, x0: float) -> None:
        level = next((v for v in GOES_ON if v in self.open), None)
        if level == "bullet":
            of, left = self.bullet_at
            if x0 < (left - 2 if page == of else left + 0.5):  # further left than the bullet
                self.open.pop("bullet"), self.open.pop("sub", None)
                level = None
        if level is None:
            self.add("plain", text)
            return
        at = self.open[level]
        if level == "num":
            child = self.under("last of num")
            at = at if child is None else child
        if at != _LOST:
            old = self.items[at][2]
            self.items[at][2] = _squeeze(f"{old} {text}") if old else text


def hierarchy(entries: list[tuple[int, float, str, str, float]], compat: bool = False) -> list[tuple[int, str, str]]:
    """(parent, kind, text) of the items of a block, by the rules of RULES.

    By default plain lines after a note that stands alone are added to it; ``compat`` loses them, as they'd go to an
    item that is attached nowhere.
    """
    t = _Tree(compat)
    for page, _, kind, text, x0 in entries:
        text = _squeeze(text)
        if kind != "plain":
            t.enter(kind, text)
            if kind == "bullet":
                t.bullet_at = (page, x0)
        elif text:
            t.plain(text, page, x0)
    if all(kind == "plain" for _, kind, _ in t.items):
        text = _squeeze(" ".join(x for _, _, x in t.items if x))
        return [(-1, "text", text)] if text else []
    return [tuple(i) for i in t.items]


def greedy_page(pdf: pd.DataFrame, near: float = 2.0) -> pd.DataFrame:
    pdf = pdf.sort_values("word_idx")
    opened: list[float] = []
    of = []
    for top in pdf["top"]:
        key = next((k for k in opened if abs(k - top) <= near), None)
        if key is None:
            opened.append(key := top)
        of.append(key)
    pdf = pdf.assign(line_key=of)
    ordered, moved = sorted(opened), {}
    for i, key in enumerate(ordered):
        mine = pdf[(pdf["line_key"] == key) & (pdf["size"] >= 6)]
        texts = mine["text"].str.strip().tolist()
        fonts = mine["fontname"].tolist()
        # words moved here from a bucket before count too
        texts += [t for k, (to, t, f) in moved.items() if to == key]
        fonts += [f for k, (to, t, f) in moved.items() if to == key]
        if len(texts) == 1 and len(texts[0]) == 1 and texts[0].isupper() and not any(m in fonts[0] for m in ("SymbolMT", "Wingdings", "Courier")):
            for j in (i + 1, i - 1):
                if 0 <= j < len(ordered) and abs(ordered[j] - key) <= 8 and ordered[j] not in moved:
                    moved[key] = (ordered[j], texts[0], fonts[0])
                    break
    target = {k: to for k, (to, _, _) in moved.items()}
    keep = ~((pdf["size"] < 6) & pdf["line_key"].isin(list(target)))
    return pdf[keep].assign(line_key=pdf["line_key"].map(lambda k: target.get(k, k)))


class _Section:
    """Nodes of a section while tables are put in: its children, and those of its subsections by parent."""

    def __init__(self, rows: list[dict], company: str):
        self.heading = (rows[0]["segment"] or "").lower()
        self.children = [r for r in rows if r["parent"] == "section"]
        self.inner = {f"sub{int(c['sub'])}": [] for c in self.children if c["kind"] == "subsection"}
        self.sub = {f"sub{int(c['sub'])}": c for c in self.children if c["kind"] == "subsection"}
        for r in rows:
            if r["parent"] in self.inner:
                self.inner[r["parent"]].append(r)
        self.footers = (company.lower(), "operating subsidiaries", "© 20")

    def named(self, *words: str) -> str | None:
        return next((p for p, s in self.sub.items() if any(w in (s["heading"] or "").lower() for w in words)), None)

    def of(self, parent: str) -> list[dict]:
        return self.children if parent == "section" else self.inner[parent]

    def flat(self) -> list[dict]:
        out: list[dict] = []
        for c in self.children:
            out.append(c)
            if c["kind"] == "subsection":
                out += self.inner[f"sub{int(c['sub'])}"]
        return out


def _text(node: dict) -> str:
    return node["text"] or ""


def _first(nodes: list[dict], test, default: int) -> int:
    return next((i for i, c in enumerate(nodes) if test(c)), default)


def _is(*kinds: str):
    return lambda c: c["kind"] in kinds


# Places of tables: from the section and the table to (parent, index), or None where the rule doesn't hold.


def _at_end(s: _Section, t: dict):
    """Before the first paragraph or footnote of the page's footer, else at the end."""
    return "section", _first(s.children, lambda c: c["kind"] in ("paragraph", "footnote") and any(f in _text(c).lower() for f in s.footers), len(s.children))


def _after_title(nodes: list[dict], title: str) -> int:
    return _first(nodes, lambda c: c["kind"] == "paragraph" and title and _text(c).startswith(title), len(nodes) - 1) + 1


def _after_leading_tables(s: _Section, t: dict):
    if (p := s.named("drug quantity", "quantity limit")) is None:
        return None
    head = s.inner[p][: _first(s.inner[p], _is("paragraph"), len(s.inner[p]))]
    return p, max((i + 1 for i, c in enumerate(head) if c["kind"] == "table"), default=0)


def _in_availability(s: _Section, t: dict):
    p = s.named("availability")
    return None if p is None else (p, _after_title(s.inner[p], t["title"]))


def _after_last_paragraph(s: _Section, t: dict):
    paragraphs = [i for i, c in enumerate(s.children) if c["kind"] == "paragraph"]
    return "section", paragraphs[-1] + 1 if paragraphs else _first(s.children, _is("footnote"), len(s.children))


def _before_notes(s: _Section, t: dict):
    return "section", _first(s.children, lambda c: c["kind"] == "footnote" or c["kind"] == "paragraph" and _text(c).startswith("*"), 0)


def _with_plan(s: _Section, t: dict):
    if (p := s.named("employer", "individual", "family")) is not None:
        return p, len(s.inner[p])
    plans = lambda c: c["kind"] == "paragraph" and len(_text(c)) < 30 and any(w in _text(c).lower() for w in ("employer plans", "individual and family", "individual/family"))
    return next(((p, i + 1) for p, nodes in s.inner.items() for i, c in enumerate(nodes) if plans(c)), None)


def _in_active(s: _Section, t: dict):
    active = [p for p, c in s.sub.items() if (c["page"], c["top"]) <= (t["page"], t["top"])]
    if not active:
        return None
    nodes = s.inner[active[-1]]
    at = _after_title(nodes, t["title"][:30])
    return active[-1], next((i for i in range(at, len(nodes)) if nodes[i]["kind"] != "table"), len(nodes))


#: Kind of table, words of which the section's heading needs one (none: any), and the place. Where no rule gives one: at the end.
INSERTIONS = [
    ("revision", ("revision",), lambda s, t: ("section", 0)),
    ("dql", (), _after_leading_tables),
    ("availability", (), _in_availability),
    ("hcpcs", ("coding",), _after_last_paragraph),
    ("moa", (), _before_notes),
    ("criteria", ("coverage", "medical necessity"), _with_plan),
    ("generic", (), _in_active),
]


def inject(rows: list[dict], tables: list[dict], company: str = "publisher") -> list[dict]:
    """Nodes of one section with its tables."""
    rules = {kind: (words, place) for kind, words, place in INSERTIONS}
    s = _Section(sorted(rows, key=lambda r: r["ord"]), company)
    for t in sorted(tables, key=lambda t: t["position"]):
        t = {**t, "title": (t["title"] or "").strip()}
        words, place = rules.get(t["table_type"], ((), lambda s, t: None))
        fits = not words or any(w in s.heading for w in words)
        parent, at = (place(s, t) if fits else None) or _at_end(s, t)
        s.of(parent).insert(at, {**t, "kind": "table", "parent": parent, "heading": t["title"], "text": None})
    return s.flat()
