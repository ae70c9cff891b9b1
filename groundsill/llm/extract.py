"""HTML extraction with wrappers: union-free regular expressions inferred from pages of one host.

A page becomes a stream of tags and text. Repeats in a row are folded into repeated groups. Streams of
a bounded sample of a host's pages are then aligned one after the other: text that differs becomes
a slot, tags that one side lacks an optional group, and a group met more or less often a repeated one.

Every page is then matched against its host's wrapper, which tells the place of each text. Text that
nearly all pages of the host have in the same place is template and left out, if it is an inner
container's whole text; text in slots and stretches that the wrapper does not fit are kept.
Containers that say by name that they are menus, adverts, forms or comments are left out, unless they
hold most of the page's text. The main text is what is then left in the article elements; without any, in the container that holds most of the
host's other text.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsill.llm import urls
from groundsill.llm.tables import bounded_sample, free_name, in_small_batches
from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

SAMPLE = 12
LOOK_AHEAD = 48
LONGEST_UNIT = 24
TEMPLATE = 0.9  # share of a host's pages that have a text in the same place, if it is template

_COUNTED = pa.list_(pa.struct([("unit", pa.int64()), ("path", pa.string()), ("n", pa.int64())]))

# Elements and words of the HTML vocabulary.
CONTAINERS = frozenset(
    "html head body main article section div nav header footer aside form ul ol dl table menu dialog"
    " figure details fieldset center noscript template iframe object select textarea button svg"
    " blockquote".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span"
    " strike strong sub sup time tt u var wbr label".split())
LEFT_OUT = frozenset(
    "head nav footer aside form menu dialog noscript template iframe object select textarea button"
    " svg".split())
ROOTS = frozenset(["article", "main"])
SMALL = frozenset("p li h1 h2 h3 h4 h5 h6 span td dd dt".split())
CLOSED_BY_NEXT = {"p": frozenset(["p", *CONTAINERS]), "li": frozenset(["li"]),
                  "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"])}
NEVER_BY_NAME = frozenset(["html", "body", "main", "article"])
VOID_LEFT_OUT = frozenset(["header"])
# A class, id or role names a left-out container if all its words are known and one of them says so.
NAMES_LEFT_OUT = re.compile(
    r"ads?|nav|navbar|navigation|share|sharing|social|sponsor(ed|s)?|promo(tion|s)?|banners?|menus?"
    r"|widgets?|masthead|consent|notices?|alerts?|modal|overlay|replies|respond|disqus|search"
    r"|related|recommend(ed|ations)?|pagination|pager|toolbar|contentinfo|complementary|hidden"
    r"|gdpr|feedback|disclaimers?|tags|taglist|signup|login|subscription|advert(s|isement|isements|ising)?|breadcrumbs?|sidebars?|footers?"
    r"|siteheader|pageheader|cookies?|cookiebar|popups?|comments?|commentlist|newsletters?|subscribe")
WORDS_BESIDE = frozenset(
    "9 a and area article articles aside bar big block blog body bottom box button buttons card cards"
    " column container content desktop dropdown entry fb field footer for form global google group"
    " header holder icon icons inline inner input item items layer left level link links list lists"
    " local main media mobile module my nav news of on outer page panel popular post posts primary"
    " reader readers responsive right row secondary section site slot small stories story tab text the thread title"
    " to toggle top topbar twitter unit us user video wrap wrapper".split())
_JOINED = re.compile(r"\b(site|page|side|pop|sign|log|nav)[-_](header|bar|up|in)\b")
NAMES_ROOT = re.compile(r"(?<![a-z])(article|post|entry|story)-?(body|content|text|main)?(?![a-z-])")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


@dataclass
class Node:
    """One part of a wrapper: a tag, a text, or an optional or repeated group."""

    kind: str
    name: str = ""
    path: tuple[str, ...] = ()
    body: list["Node"] = field(default_factory=list)
    values: dict[int, str] = field(default_factory=dict)

    def same(self, other: "Node") -> bool:
        if self.kind != other.kind or self.name != other.name or self.path != other.path:
            return False
        return len(self.body) == len(other.body) and all(
            a.same(b) for a, b in zip(self.body, other.body, strict=True))

    def __str__(self) -> str:
        if self.kind == "tag":
            return f"<{self.name}>"
        if self.kind == "text":
            said = set(self.values.values())
            return next(iter(said)) if len(said) == 1 else "#TEXT"
        return "(" + " ".join(map(str, self.body)) + (")?" if self.kind == "optional" else ")+")


def _signature(tag: str, attributes: str) -> str:
    """The tag, ``hidden`` if its attributes say so, and all words of its class, id and role."""
    names, hidden = [], False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), next(filter(None, m.groups()[1:]), "")
        if name in ("class", "id", "role"):
            names.append(value)
        hidden = hidden or name == "hidden" or (
            name == "aria-hidden" and value.strip().lower() == "true") or (
            name == "style" and _UNSEEN.search(value) is not None)
    words = re.sub(r"\d+", "9", " ".join(names).lower()).split()
    return " ".join([tag, *(["hidden"] if hidden else []), *words])


def _remembered(most: int) -> Callable[[Callable], Callable]:
    """A cache of at most ``most`` answers that travels with the task's code, as the function does."""
    def around(answer: Callable) -> Callable:
        known: dict = {}

        def look(asked):
            if asked not in known:
                if len(known) >= most:
                    known.clear()
                known[asked] = answer(asked)
            return known[asked]

        return look

    return around


_SIGNATURES: dict[tuple[str, str], str] = {}


def _signed(tag: str, attributes: str) -> str:
    if not attributes.strip():
        return tag
    known = _SIGNATURES.get((tag, attributes))
    if known is None:
        if len(_SIGNATURES) > 50_000:
            _SIGNATURES.clear()
        known = _SIGNATURES[tag, attributes] = _signature(tag, attributes)
    return known


def events(page: str) -> Iterator[tuple[str, str, tuple[str, ...]]]:
    """``(kind, value, path)``: kind ``open``, ``close`` or ``text``, and the containers around.
    An end tag closes what was left open inside; one that closes nothing is passed over."""
    path: tuple[str, ...] = ()
    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            yield "text", page[at : found.start()], path
        at = found.end()
        if found[3] is None:
            continue
        tag = found[3].lower()
        if path and not found[2] and tag in CLOSED_BY_NEXT.get(path[-1].split(" ", 1)[0], ()):
            path = path[:-1]
        # Small elements count as containers only where their name says that they are left out.
        small = tag in SMALL and (
            any(p.startswith(f"{tag} ") for p in path) if found[2]
            else _left_out(_signed(tag, found[4])))
        if tag not in CONTAINERS and not small:
            yield ("close" if found[2] else "open"), tag, path
        elif not found[2]:
            if tag == "body":
                path = path[:1] if path[:1] == ("html",) else ()
            yield "open", (signed := _signed(tag, found[4])), path
            if not found[4].rstrip().endswith("/"):
                path += (signed,)
        else:
            for k in range(len(path) - 1, -1, -1):
                if path[k].split(" ", 1)[0] == tag:
                    path = path[:k]
                    break
            yield "close", tag, path
    if at < len(page):
        yield "text", page[at:], path


def _folded(nodes: list[Node]) -> list[Node]:
    """Repeats in a row as one repeated group each, shortest units first, until nothing folds."""
    unit = 1
    while unit <= min(LONGEST_UNIT, len(nodes) // 2):
        out, i = [], 0
        while i < len(nodes):
            body, end = nodes[i : i + unit], i + unit
            while end + unit <= len(nodes) and all(
                    a.same(b) for a, b in zip(body, nodes[end : end + unit], strict=True)):
                for a, b in zip(body, nodes[end : end + unit], strict=True):
                    _absorb(a, b)
                end += unit
            if end > i + unit:
                # A lone repeated group only takes its neighbours in.
                alone = unit == 1 and body[0].kind == "repeat"
                out.append(body[0] if alone else Node("repeat", path=body[0].path, body=body))
                i = end
            else:
                out.append(nodes[i])
                i += 1
        unit = 1 if len(out) < len(nodes) else unit + 1
        nodes = out
    return nodes


def _absorb(into: Node, other: Node) -> None:
    for page, said in other.values.items():
        into.values[page] = f"{into.values[page]} {said}" if page in into.values else said
    for a, b in zip(into.body, other.body, strict=False):
        _absorb(a, b)


def stream(page: str, number: int) -> list[Node]:
    out = []
    for kind, value, path in events(page):
        if kind == "text":
            said = " ".join(html.unescape(value).split())
            if said:
                out.append(Node("text", path=path, values={number: said}))
        else:
            out.append(Node("tag", value if kind == "open" else f"/{value}", path))
    return _folded(out)


def _consume(group: Node, nodes: list[Node], at: int) -> int:
    """How many of ``nodes`` from ``at`` on the group's body takes, once or, if repeated, as often
    as it fits; their text is absorbed."""
    size, taken = len(group.body), 0
    while size and at + taken + size <= len(nodes) and all(
            a.same(b) for a, b in zip(group.body, nodes[at + taken : at + taken + size], strict=True)):
        for a, b in zip(group.body, nodes[at + taken : at + taken + size], strict=True):
            _absorb(a, b)
        taken += size
        if group.kind == "optional":
            break
    return taken


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper, made general enough to fit ``page`` as well."""
    out, i, j = [], 0, 0
    while i < len(wrapper) and j < len(page):
        w, p = wrapper[i], page[j]
        if w.same(p):
            _absorb(w, p)
            out.append(w)
            i, j = i + 1, j + 1
        elif w.kind in ("repeat", "optional") and (taken := _consume(w, page, j)):
            out.append(w)
            i, j = i + 1, j + taken
        elif p.kind == "repeat" and (taken := _consume(p, wrapper, i)):
            out.append(p)
            i, j = i + taken, j + 1
        elif w.kind == "optional":
            out.append(w)
            i += 1
        else:
            a, b = _next_match(wrapper[i:], page[j:])
            if a:
                out.append(Node("optional", path=w.path, body=wrapper[i : i + a]))
            if b:
                out.append(Node("optional", path=p.path, body=page[j : j + b]))
            i, j = i + a, j + b
    for rest in (wrapper[i:], page[j:]):
        if rest:
            out.append(Node("optional", path=rest[0].path, body=rest))
    return out


def _next_match(wrapper: list[Node], page: list[Node]) -> tuple[int, int]:
    """The nearest places at which both go on alike; else their ends."""
    for far in range(1, 2 * LOOK_AHEAD):
        for a in range(max(0, far - LOOK_AHEAD), min(far, LOOK_AHEAD) + 1):
            b = far - a
            if a < len(wrapper) and b < len(page) and wrapper[a].same(page[b]):
                return a, b
    return len(wrapper), len(page)


def infer(pages: list[str]) -> list[Node]:
    """The wrapper of some pages of one host."""
    wrapper: list[Node] = []
    for number, page in enumerate(pages):
        nodes = stream(page, number)
        wrapper = align(wrapper, nodes) if wrapper else nodes
    return wrapper


def _says_left_out(name: str) -> bool:
    said = [x for x in re.split("[-_]+", _JOINED.sub(r"\1\2", name)) if x]
    named = [bool(NAMES_LEFT_OUT.fullmatch(x)) for x in said]
    return any(named) and all(n or x in WORDS_BESIDE for n, x in zip(named, said, strict=True))


@_remembered(100_000)
def _left_out(sign: str) -> bool:
    tag, _, names = sign.partition(" ")
    return tag in LEFT_OUT or (
        tag not in NEVER_BY_NAME and any(map(_says_left_out, names.split())))


def _soft(sign: str) -> bool:
    """Left out by a name, or a form: such a container can also stand around the main text."""
    tag = sign.split(" ", 1)[0]
    return _left_out(sign) and (tag == "form" or tag not in LEFT_OUT)


@_remembered(100_000)
def _is_root(sign: str) -> bool:
    tag, _, names = sign.partition(" ")
    return tag in ROOTS or bool(names and tag not in NEVER_BY_NAME and not _left_out(sign)
                                and NAMES_ROOT.search(names))


@_remembered(200_000)
def _by_name(path: tuple[str, ...]) -> tuple[str, int, int]:
    """What names say of a path: ``in``; ``out``; ``around``, if a container that a name leaves out stands
    around an article; or ``soft``, if one does without an article in it and nothing else leaves the
    path out. Then at which depth the article begins (or -1) and the first such container is (or
    -1). A header is left out unless it lies within an article; ``main``, of which a page has
    one, is never left out by a name around it."""
    root = soft = around = -1
    for depth, sign in enumerate(path):
        tag = sign.split(" ", 1)[0]
        if _left_out(sign):
            if not _soft(sign):
                return "out", root, -1
            soft = depth if soft < 0 else soft
        elif tag in VOID_LEFT_OUT and root < 0:
            return "out", root, -1
        elif (root < 0 or soft >= 0) and _is_root(sign):
            if soft >= 0 and tag != "main":
                around = soft
            root, soft = depth, -1
    if soft >= 0:
        alone = root < 0 and not any(map(_left_out, path[soft + 1 :]))
        return ("soft" if alone else "out"), root, soft
    return ("around" if around >= 0 else "in"), root, around


@dataclass
class Step:
    """A part of a wrapper as pages are matched against it: a token's number, or a group's steps."""

    kind: str
    token: int = -1
    cell: int = 0
    body: list["Step"] = field(default_factory=list)
    firsts: frozenset = frozenset()


def encoded(wrapper: list[Node]) -> str:
    """A wrapper without its texts: the tokens it knows, and its parts as numbers of tokens."""
    paths: dict[tuple, int] = {}
    tokens: dict[tuple, int] = {}

    def part(node: Node) -> int | list:
        if node.kind in ("tag", "text"):
            key = node.kind, node.name, paths.setdefault(node.path, len(paths))
            return tokens.setdefault(key, len(tokens))
        return [node.kind, *map(part, node.body)]

    parts = [part(node) for node in wrapper]
    return json.dumps([list(map(list, paths)), list(map(list, tokens)), parts])


class Plan:
    """A wrapper that pages are matched against. Each element of it that holds text is a cell."""

    def __init__(self, said: str):
        paths, tokens, parts = json.loads(said)
        self.keys = [(kind, name, tuple(paths[k])) for kind, name, k in tokens]
        self.numbers = {key: n for n, key in enumerate(self.keys)}
        self.opened: dict[tuple, int] = {}
        self.cells = 0
        self.steps = [self._step(part) for part in parts]

    def _step(self, part: int | list) -> Step:
        if isinstance(part, list):
            body = [self._step(x) for x in part[1:]]
            firsts: set[int] = set()
            for step in body:
                firsts |= step.firsts
                if step.kind != "optional":
                    break
            return Step(part[0], body=body, firsts=frozenset(firsts))
        kind, name, path = self.keys[part]
        if kind == "tag":
            self.cells += 1
            self.opened[(*path, name)] = self.cells
            return Step(kind, part, firsts=frozenset([part]))
        return Step(kind, part, self.opened.get(path, 0), firsts=frozenset([part]))

    def _all(self, steps: list[Step], seen: list[int], at: int, marks: list) -> int:
        """Where the steps end if they fit ``seen`` from ``at`` on, else -1."""
        for step in steps:
            if step.body:
                end = self._group(step, seen, at, marks)
                if end == at and step.kind == "repeat":
                    return -1
                at = end
            elif at < len(seen) and seen[at] == step.token:
                if step.kind == "text":
                    marks.append((at, step.cell))
                at += 1
            else:
                return -1
        return at

    def _group(self, group: Step, seen: list[int], at: int, marks: list) -> int:
        while at < len(seen) and seen[at] in group.firsts:
            held = len(marks)
            end = self._all(group.body, seen, at, marks)
            if end <= at:
                del marks[held:]
                break
            at = end
            if group.kind == "optional":
                break
        return at

    def match(self, tokens: list[tuple]) -> dict[int, int]:
        """The cell of each text of a page that the wrapper fits. Where page and wrapper differ, both go on
        at the nearest places that are alike, and what lies between stays unmatched."""
        seen = [self.numbers.get(token, -1) for token in tokens]
        marks: list[tuple[int, int]] = []
        i = j = 0
        while i < len(self.steps) and j < len(seen):
            step = self.steps[i]
            end = (self._group(step, seen, j, marks) if step.body
                   else max(self._all([step], seen, j, marks), j))
            if end > j or step.kind == "optional":
                i, j = i + 1, end
                continue
            near = _nearest(self.steps[i : i + LOOK_AHEAD], seen, j)
            if near is None:
                break
            i, j = i + near[0], j + near[1]
        return dict(marks)


def _nearest(steps: list[Step], seen: list[int], at: int) -> tuple[int, int] | None:
    """How many steps and tokens to pass over until both are alike."""
    first: dict[int, int] = {}
    later: dict[int, int] = {}
    for a, step in enumerate(steps):
        for token in step.firsts:
            first.setdefault(token, a)
            if a:
                later.setdefault(token, a)
    best = None
    for b in range(len(seen) - at):
        if best and b >= sum(best):
            break
        a = (first if b else later).get(seen[at + b])
        if a is not None and (best is None or a + b < sum(best)):
            best = a, b
    return best


def hash64(*said: str) -> int:
    digest = hashlib.blake2b("\0".join(said).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(digest.digest(), "big", signed=True) or 1


@dataclass
class Piece:
    """A text of a page, or the white space of a block's edge (``container`` is None): which element
    of the page it lies in, the containers around, where on the path an article begins, and
    which token of the page it is."""

    text: str
    container: int | None = None
    path: tuple[str, ...] = ()
    root: int = -1
    token: int = -1


def pieces(page: str) -> tuple[bool, list[Piece], list[tuple]]:
    """Whether the page has an article; in order the texts that names leave in: those of the
    article, or all without one; and the page's tokens, as a wrapper names them.

    A name does not leave out a container that holds most of the page's text: articles in such
    containers count if they hold more than the other articles do, and without any article the
    largest such container does if it holds more than what names leave in.
    """
    found: list[tuple[str, int, Piece]] = []
    tokens: list[tuple] = []
    inside: list[int] = []
    has_root, last_open = False, -1
    volume: dict[str, int] = defaultdict(int)
    held: dict[int, int] = defaultdict(int)
    for number, (kind, value, path) in enumerate(events(page)):
        del inside[len(path):]
        if len(inside) < len(path):
            inside.append(last_open)
        if kind == "open":
            last_open = number
        if kind != "text":
            tokens.append(("tag", value if kind == "open" else f"/{value}", path))
            if value not in INLINE:
                found.append(("", -1, Piece(" ")))
            has_root = has_root or (
                kind == "open" and _is_root(value) and _by_name((*path, value))[0] == "in")
            continue
        said = html.unescape(value)
        if said and not said.isspace():
            tokens.append(("text", "", path))
        how, root, depth = _by_name(path)
        if how != "out":
            top = inside[depth] if how == "soft" else -1
            found.append((how, top, Piece(said, inside[-1] if inside else -1, path, root, len(tokens) - 1)))
            size = len(said.strip())
            held[top] += size if how == "soft" else 0
            volume["article" if how == "in" and root >= 0 else how] += size
    kept = {"", "in"}
    if volume["around"] > volume["article"]:
        kept.add("around")
        has_root = True
    largest = max(held, key=held.__getitem__, default=-1)
    if not has_root and held[largest] > volume["in"]:
        kept.add("soft")
    return has_root, [x for how, top, x in found if how in kept and (how != "soft" or top == largest) and (
        not has_root or x.container is None or x.root >= 0)], tokens


def units(found: list[Piece], tokens: list[tuple], plan: Plan | None) -> dict[int, tuple[int, Piece, str]]:
    """Per element with text of its own: its unit, a piece of it, and its text. The unit is a hash of
    the wrapper's cell and the text. It is 0 for what is never template: the article element itself,
    and elements whose texts the wrapper does not fit or deals out to several cells."""
    own: dict[int, list[Piece]] = defaultdict(list)
    for piece in found:
        if piece.container is not None and not piece.text.isspace():
            own[piece.container].append(piece)
    cells: dict[int, int] | None = None
    out = {}
    for container, mine in own.items():
        first, text = mine[0], " ".join(" ".join(x.text for x in mine).split())
        unit = 0
        if plan and (first.root < 0 or len(first.path) > first.root + 1):
            if cells is None:
                cells = plan.match(tokens)
            met = {cells.get(x.token, -1) for x in mine}
            if len(met) == 1 and -1 not in met:
                unit = hash64(str(met.pop()), text)
        out[container] = unit, first, text
    return out


def described(page: str, wrapper: str | None) -> tuple[int, list[dict]]:
    """What is counted of a page: a hash of the text that cannot be template, and of each element
    its unit, its path (null within an article) and how much text it has."""
    has_root, found, tokens = pieces(page)
    listed = units(found, tokens, _planned(wrapper) if wrapper else None).values()
    rest = hash64(*(text for unit, _, text in listed if not unit))
    return rest, [{"unit": unit, "path": None if has_root else "".join(f"{x}\n" for x in piece.path),
                   "n": len(text)} for unit, piece, text in listed if unit or not has_root]


def _widened(path: tuple[str, ...], shared: dict[int, int]) -> tuple[str, ...]:
    """The container of most text, or one around it that adds little more, such as a title.
    ``shared``: how much text has exactly so many containers in common with the path."""

    def inside(depth: int) -> int:
        return sum(n for d, n in shared.items() if d >= depth)

    while path and path[-2:-1] and path[-2].split(" ", 1)[0] not in ("html", "body") and (
            inside(len(path) - 1) <= 1.3 * inside(len(path))):
        path = path[:-1]
    return path


@_remembered(64)
def _planned(wrapper: str) -> Plan:
    return Plan(wrapper)


@_remembered(256)
def _parsed(rules: str) -> tuple[tuple[str, ...] | None, frozenset]:
    said = json.loads(rules)
    main = said.get("main")
    if main is not None:
        main = _widened(tuple(main.split("\n")[:-1]), {x["depth"]: x["n"] for x in said["shared"]})
    return main, frozenset(said.get("fixed") or ())


def main_text(page: str | None, rules: str | None, wrapper: str | None = None) -> str:
    """The page's main text: white space as single spaces, blocks in order, references decoded."""
    if not page:
        return ""
    main, fixed = _parsed(rules) if rules else (None, frozenset())
    has_root, found, tokens = pieces(page)
    if not has_root and main is not None:
        inside = [x for x in found if x.container is None or x.path[: len(main)] == main]
        if any(not x.text.isspace() for x in inside):  # else a page unlike its host's others
            found = inside
    if fixed and wrapper:
        listed = units(found, tokens, _planned(wrapper))
        template = {c for c, (unit, _, _) in listed.items() if unit in fixed}
        # What holds most of a page's text is not template, however often it is met.
        if 2 * sum(len(listed[c][2]) for c in template) <= sum(len(x[2]) for x in listed.values()):
            found = [x for x in found if x.container not in template]
    return " ".join("".join(x.text for x in found).split())


def _hosted(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    return pages.select(urls.host(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html")).where("html <> ''")


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html",
             sample: int = SAMPLE) -> DataFrame:
    """``host, wrapper, parts`` per host (in words, and as pages are matched against it), from at most ``sample`` of its pages, chosen by hash."""
    chosen = bounded_sample(_hosted(pages, url_col, html_col), "host", sample, F.xxhash64("html"))

    def learn(table: pa.Table) -> pa.Table:
        wrapper = infer(sorted(table.column("html").to_pylist()))
        return pa.table({"host": table.column("host").slice(0, 1),
                         "wrapper": [" ".join(map(str, wrapper))],
                         "parts": [encoded(wrapper)]})

    return chosen.select("host", "html").groupBy("host").applyInArrow(
        learn, "host string, wrapper string, parts string")


def rules(pages: DataFrame, learned: DataFrame, url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """``host, rules, parts`` per host, counted over all of its pages, each matched against the
    host's wrapper in ``learned`` (``host, parts``).

    ``fixed``: units (the wrapper's cell and the text) that at least ``TEMPLATE`` of the pages have, and three
    pages, if the text that they leave still takes three forms; copies of one page have no
    template. ``main``: the container of most other text on pages without an article.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [described(page.as_py(), parts.as_py()) for page, parts in zip(
                batch.column("html"), batch.column("parts"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([x[0] for x in found], pa.int64()),
                 pa.array([x[1] for x in found], _COUNTED)], ["host", "rest", "listed"])

    hosted = in_small_batches(_hosted(pages, url_col, html_col))
    seen = materialize(hosted.join(learned, "host", "left").mapInArrow(
        count, "host string, rest bigint, listed array<struct<unit:bigint,path:string,n:bigint>>"))
    hosts = seen.groupBy("host").agg(F.count("*").alias("pages"))
    met = seen.select("host", F.explode(F.array_distinct("listed.unit")).alias("unit")).where(
        "unit <> 0").groupBy("host", "unit").agg(F.count("*").alias("met"))
    often = materialize(hosts.join(met, "host").where(
        (F.col("met") >= 3) & (F.col("met") >= TEMPLATE * F.col("pages"))).groupBy("host").agg(
            F.sort_array(F.collect_list("unit")).alias("often")))
    left = seen.join(often, "host", "left").withColumn("left", F.filter(
        "listed", lambda x: ~F.coalesce(F.array_contains(F.col("often"), x["unit"]), F.lit(False))))
    forms = left.where("often is not null").groupBy("host").agg(F.count_distinct(F.aggregate(
        F.array_distinct("left.unit"), F.col("rest"), lambda a, x: a.bitwiseXOR(x))).alias("forms"))
    volume = materialize(left.select("host", F.explode("left").alias("x")).where(
        "x.path is not null").groupBy("host", "x.path").agg(F.sum("x.n").alias("n")))
    tops = volume.groupBy("host").agg(F.max(F.struct("n", "path"))["path"].alias("main"))
    names = F.split("main", "\n")
    depth = F.size(F.filter(
        F.sequence(F.lit(1), F.size(names)), lambda k: (k < F.size(names)) & F.startswith(
            F.col("path"), F.concat(F.array_join(F.slice(names, 1, k), "\n"), F.lit("\n")))))
    shared = volume.join(tops, "host").groupBy("host", "main", depth.alias("depth")).agg(
        F.sum("n").alias("n")).groupBy("host", "main").agg(
            F.collect_list(F.struct("depth", "n")).alias("shared"))
    fixed = often.join(forms, "host").where("forms >= 3").select("host", F.col("often").alias("fixed"))
    # Hosts without template need no wrapper any more.
    return hosts.select("host").join(shared, "host", "left").join(fixed, "host", "left").join(
        learned, "host", "left").select(
            "host", F.to_json(F.struct("main", "shared", "fixed")).alias("rules"),
            F.when(F.col("fixed").isNotNull(), F.col("parts")).alias("parts"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html",
            sample: int = SAMPLE) -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``; columns of those names are replaced.

    A null or empty html gives an empty text. Pages whose url is null or has no host share the
    wrapper of the empty host. Stretches of a page that its host's wrapper does not fit are judged by
    the names of their containers alone.
    """
    base = in_small_batches(pages).drop("text", "n_chars")
    host, said = free_name(base, "page_host"), free_name(base, "page_rules")
    wrapped = free_name(base, "page_wrapper")
    # Both stored, so that their size is known and Spark broadcasts them only if they are small.
    inferred = materialize(wrappers(pages, url_col, html_col, sample).select("host", "parts"))
    learned = materialize(rules(pages, inferred, url_col, html_col).select(
        F.col("host").alias(host), F.col("rules").alias(said), F.col("parts").alias(wrapped)))
    joined = base.withColumn(host, urls.host(F.col(url_col))).join(learned, host, "left").drop(host)
    kept = [c for c in base.columns if c != html_col]
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), told.as_py(), parts.as_py()) for page, told, parts in zip(
                batch.column(html_col), batch.column(said), batch.column(wrapped), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*kept, "text", "n_chars"])

    return joined.mapInArrow(read, ", ".join(
        [f"`{c}` {types[c]}" for c in kept] + ["text string", "n_chars bigint"]))
