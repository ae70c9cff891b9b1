"""Personal data found by rules and, where rules give up, by a semi-Markov conditional random field.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers written the usual way. They
match greedily and never try again, so neighbours spoil each other (a phone number, a space, a card
number) and other spellings are missed. The model takes over in what rules left: it scores whole
candidate segments by features of the span as a whole (lengths of its digit groups, what separates them,
check digit, octets, how an address says "at" and "dot", what stands around it) and a dynamic programme
over bounded segments chooses boundaries and types together, as the best way to cover the text. Tokens
outside of segments score zero, so a text is looked at only where candidates are.

The model learns from the rules' own finds: stretches around them, the same spans spelled otherwise or set
side by side, and look-alikes (a wrong check digit, octets above 255, dates and random digit groups).
"""

from __future__ import annotations

import heapq
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.llm.tables import in_small_batches
from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

# Fixed values of the contract: the kinds in their order, and what each rule matches.
KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MAY_HOLD = r"[0-9@]|(?i:[(\[{]\s?at\s?[)\]}])|(?i:\sdot\s)"
"""A text without any of these holds nothing that rules or model could find."""


class Span(NamedTuple):
    """Code points from ``start`` to before ``end``."""

    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) < 3 or len(short) == 3 and short <= "255"


def _emails(text: str) -> Iterator[Span]:
    """From at-sign to at-sign, so that a long run of letters is read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield Span("email", start, domain.end())
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """What the rules find, by start, then kind: per kind leftmost matches that do not overlap."""
    found = list(_emails(text))
    for m in IP.finditer(text):
        if all(map(_octet, m.group().split("."))):
            found.append(Span("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group()) if len(m.group()) < 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(Span("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= sum(map(m.group().count, "0123456789")) <= 15:
            found.append(Span("phone", *m.span()))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span.start, KINDS.index(span.kind), span.end


# --- candidate segments and their features ---------------------------------------------------------

MOST_GROUPS, LEAST_DIGITS, MOST_DIGITS = 7, 7, 19
_GROUP = re.compile(r"[0-9]+")
_SEPARATORS = {
    " ": "s", "-": "h", ".": "d", "/": "l", ") ": "p", " (": "p", ")": "p", ")-": "p", "-(": "p",
    "(": "p", " - ": "h", ". ": "ds", "[.]": "D", "(.)": "D", " . ": "D", "(dot)": "D", "[dot]": "D",
    " dot ": "D"}
_LEADS = ("+(", "(+", "+", "(")
_AT = re.compile(r"\s?@\s?|\s?[(\[{]\s?(?:at|AT)\s?[)\]}]\s?|\s(?:at|AT)\s")
_DOT = r"(?:\.|\s?[(\[{]\s?(?:dot|DOT|\.)\s?[)\]}]\s?|\s(?:dot|DOT)\s|\s\.\s)"
_DOTS = re.compile(_DOT)
_LABELS = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}")
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")


class Candidate(NamedTuple):
    start: int
    end: int
    features: tuple[str, ...]


def _around(text: str, place: int) -> str:
    """The class of one character, or that there is none."""
    if not 0 <= place < len(text):
        return "^"
    c = text[place]
    if c.isspace():
        return "s"
    if c.isalnum() or c == "_":
        return "a"
    return c if c in ".,:;+-/=#$%@" else "q"


def _numbers(text: str, start: int, groups: list[str], between: list[str], lead: str, end: int,
             more: str) -> tuple[str, ...]:
    digits = "".join(groups)
    lengths = [len(g) for g in groups]
    octets = len(groups) == 4 and set(between) <= {"d", "D"} and all(map(_octet, groups))
    check = luhn(digits) if len(digits) >= 14 else "-"
    # Groups of unusual lengths are told apart by their number only.
    shape = ".".join(map(str, lengths))
    kinds = "".join(sorted(set(between)))
    return (
        "number", f"digits {len(digits)}", f"groups {len(groups)}", f"shape {shape}",
        f"between {kinds}", f"lead {lead}", f"octets {octets} {kinds}", f"check {check}",
        f"check {check} {kinds} {len(digits)}", f"shape {shape} {kinds} {lead}",
        f"left {_around(text, start - 1)}", f"right {_around(text, end)}", f"more {more}",
        f"more {more} {shape} {kinds} {lead}", f"zeros {digits[:2] == '00'} {lead}", f"even {len(set(lengths)) == 1} {check}")


def _number_candidates(text: str) -> Iterator[Candidate]:
    """Runs of neighbouring digit groups, with or without the sign before them, by start."""
    run: list[tuple[int, int, str]] = []  # start, end, what separates it from the group before

    def of_first() -> list[Candidate]:
        start, digits, out = run[0][0], 0, []
        before = text[max(start - 2, 0) : start]
        begins = [(start - len(lead), lead) for lead in ("", *_LEADS) if before.endswith(lead)]
        begins = [(b, lead) for b, lead in begins if _around(text, b - 1) != "a"]
        for k, (a, end, _) in enumerate(run[:MOST_GROUPS]):
            digits += end - a
            if digits > MOST_DIGITS:
                break
            four = k == 3 and all(b - a <= 3 for a, b, _ in run[:4])
            if not four and (digits < LEAST_DIGITS or max(b - a for a, b, _ in run[: k + 1]) < 3):
                continue
            if _around(text, end) == "a":
                continue
            groups = [text[a:b] for a, b, _ in run[: k + 1]]
            between = [s for _, _, s in run[1 : k + 1]]
            more = f"{int(linked)}{int(k + 1 < len(run))}"
            out += [Candidate(begin, end, _numbers(text, begin, groups, between, lead, end, more))
                    for begin, lead in begins]
        return sorted(out)

    linked = False
    for m in _GROUP.finditer(text):
        mark = None
        if run:
            gap = m.start() - run[-1][1]
            mark = _SEPARATORS.get(text[run[-1][1] : m.start()]) if gap <= 5 else None
            if mark is None:
                while run:
                    yield from of_first()
                    run.pop(0)
                    linked = True
                linked = False
        run.append((m.start(), m.end(), mark or ""))
        if len(run) > MOST_GROUPS:
            yield from of_first()
            run.pop(0)
            linked = True
    while run:
        yield from of_first()
        run.pop(0)
        linked = True


def _email_candidates(text: str) -> Iterator[Candidate]:
    """What stands around an at-sign or a word for one, by start."""
    for m in _AT.finditer(text):
        name = _NAME.search(text, max(m.start() - 64, 0), m.start())
        labels = _LABELS.match(text, m.end())
        if not name or not labels:
            continue
        sign = m.group().strip().lower()
        how_at = ("plain" if m.group() == "@" else "wide" if sign == "@"
                  else "word" if sign == "at" else "held")
        dots = list(_DOTS.finditer(text, m.end(), labels.end()))
        stops = [d.start() for d in dots[1:]] + [labels.end()]
        starts = {name.start()}
        stripped = name.group().lstrip("._%+-")
        if stripped:
            starts.add(name.end() - len(stripped))
        for start in sorted(starts):
            for k, end in enumerate(stops, 1):
                used = {d.group() for d in dots[:k]}
                how_dot = "plain" if used == {"."} else "word" if any(
                    d.strip().isalpha() for d in used) else "held"
                last = text[dots[k - 1].end() : end]
                if how_at == "word" and how_dot != "word" or _around(text, end) in "a-":
                    continue
                yield Candidate(start, end, (
                    "address", f"at {how_at}", f"dot {how_dot}", f"at {how_at} dot {how_dot}",
                    f"labels {k}", f"last {min(len(last), 8)} {last.isalpha()}", f"last {last.lower()}", f"at {how_at} dot {how_dot} last {last.lower()}",
                    f"name {min(name.end() - start, 12)}", f"first {text[start].isalnum()}",
                    f"left {_around(text, start - 1)}", f"right {_around(text, end)}",
                    f"rest {k < len(stops)}"))


def candidates(text: str) -> Iterator[Candidate]:
    return heapq.merge(_number_candidates(text), _email_candidates(text), key=lambda c: c.start)


# --- the model -------------------------------------------------------------------------------------

@dataclass
class Model:
    """Weights of each feature for each kind, and of a kind that directly follows another (0: none)."""

    weights: dict[str, np.ndarray]
    follows: np.ndarray
    known: dict[tuple, list[float]] = field(default_factory=dict)

    def scores(self, features: tuple[str, ...]) -> list[float]:
        found = self.known.get(features)
        if found is None:
            if len(self.known) >= 50_000:
                self.known.clear()
            total = sum((self.weights[f] for f in features if f in self.weights),
                        np.zeros(len(KINDS)))
            found = self.known[features] = total.tolist()
        return found


_NEVER = -1e30


def best_cover(found: Iterator[Candidate], model: Model, margin: float) -> list[Span]:
    """The best-scoring segments that do not overlap. ``found`` comes by start.

    Goes from point to point where segments start or end. What is kept per kind of the last segment
    is a score and a chain of chosen segments, so memory follows what is found, not the text.
    """
    kinds = range(len(KINDS) + 1)
    follows = model.follows.tolist()
    score, chain = [0.0] + [_NEVER] * len(KINDS), [None] * (len(KINDS) + 1)
    place, ends, open_at = -1, [], {}

    def move(to: int) -> None:
        nonlocal score, chain, place
        while ends and ends[0] <= to:
            end = heapq.heappop(ends)
            step(end)
            for kind, total, before in open_at.pop(end):
                if total > score[kind]:
                    score[kind], chain[kind] = total, before
        step(to)

    def step(to: int) -> None:
        """Over text outside of segments: nothing but the best matters behind it."""
        nonlocal score, chain, place
        if to > place:
            best = max(kinds, key=score.__getitem__)
            score = [score[best]] + [_NEVER] * len(KINDS)
            chain = [chain[best]] + [None] * len(KINDS)
            place = to

    for c in found:
        move(c.start)
        for kind, gain in enumerate(model.scores(c.features), 1):
            if gain <= margin:
                continue
            last = max(kinds, key=lambda k: score[k] + follows[k][kind])
            if c.end not in open_at:
                open_at[c.end] = []
                heapq.heappush(ends, c.end)
            open_at[c.end].append((kind, score[last] + follows[last][kind] + gain - margin,
                                   (chain[last], Span(KINDS[kind - 1], c.start, c.end))))
    while ends:
        move(ends[0])
    out, link = [], chain[max(kinds, key=score.__getitem__)]
    while link:
        link, span = link
        out.append(span)
    return out[::-1]


def added_spans(text: str, base: list[Span], model: Model, margin: float) -> list[Span]:
    """The best cover by segments that touch none of the spans that are there already."""
    fixed: list[list[int]] = []
    for span in base:
        if fixed and span.start < fixed[-1][1]:
            fixed[-1][1] = max(fixed[-1][1], span.end)
        else:
            fixed.append([span.start, span.end])

    def free() -> Iterator[Candidate]:
        at = 0
        for c in candidates(text):
            while at < len(fixed) and fixed[at][1] <= c.start:
                at += 1
            if at == len(fixed) or fixed[at][0] >= c.end:
                yield c

    return best_cover(free(), model, margin)


@dataclass(frozen=True)
class Training:
    """The model learns from at most ``windows`` different stretches per kind, and as many around
    candidates that are nothing. ``reach``: characters on both sides of a span."""

    windows: int = 100
    reach: int = 40
    epochs: int = 10
    rate: float = 0.5
    shrink: float = 1e-4
    seed: int = 7


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _respelled(kind: str, said: str, chance: random.Random) -> str:
    """The same datum in another common spelling."""
    if kind == "email":
        at = chance.choice(["@", " @ ", "(at)", "[at]", " (at) ", " [at] ", " at ", " at "])
        dot = " dot " if at == " at " else chance.choice(
            [".", ".", "[.]", "(dot)", "[dot]", " [dot] ", " dot "])
        name, _, domain = said.partition("@")
        if domain.count(".") > 1 and chance.random() < 0.4:
            domain = domain.partition(".")[2]
        return name + at + domain.replace(".", dot)
    if kind == "ip":
        dots = chance.choice([[".", ".", "[.]"], ["[.]"] * 3, ["(dot)"] * 3, [" . "] * 3, ["[dot]"] * 3])
        parts = said.split(".")
        return parts[0] + "".join(d + p for d, p in zip(dots, parts[1:], strict=True))
    digits = _digits(said)
    if kind == "card":
        gap = chance.choice([" ", "-", ".", "/", ""])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    code, area, rest = digits[:-10], digits[-10:-7], digits[-7:]
    a, b = rest[:3], rest[3:]
    code = code or "1"
    return chance.choice([
        f"({area}) {a}-{b}", f"({area}) {a}-{b}", f"({area}) {a} {b}", f"{area}-{a}-{b}", f"{code}-{area}-{a}-{b}",
        f"00{code} {area} {a} {b}", f"00{code} ({area}) {a}-{b}", f"+{code}-{area}-{a}-{b}",
        f"+{code} {area} {a} {b}", f"+{code} ({area}) {a}-{b}", f"+{code}.{area}.{a}.{b}",
        f"{code} ({area}) {a}-{b}"])


def _look_alike(kind: str, said: str, around: str, chance: random.Random) -> str:
    """Something that resembles the datum and is none, also made of the words around it."""
    def number(size: int) -> str:
        return "".join(chance.choice("0123456789") for _ in range(size))

    pick = chance.randrange(4)
    if pick == 0 and kind == "card":
        digits = _digits(said)
        wrong = digits[:-1] + str((int(digits[-1]) + chance.randint(1, 9)) % 10)
        return _respelled("card", wrong, chance)
    if pick == 0 and kind == "ip":
        parts = said.split(".")
        parts[chance.randrange(4)] = str(chance.randint(256, 999))
        return ".".join(parts)
    if kind == "email" and pick == 0:
        words = re.findall("[^\\W\\d_]+", around) or ["this"]
        return "{} at {} dot {}".format(*(chance.choice(words) for _ in range(3)))
    if pick < 2:
        year, month, day = chance.randint(1900, 2099), chance.randint(1, 12), chance.randint(1, 28)
        return chance.choice([
            f"{year}-{month:02}-{day:02}", f"{day}.{month}.{year}", f"{month}/{day}/{year}",
            f"{year}-{month:02}-{day:02} {day:02}", f"{year}-{year + 1} {year + 2}",
            f"{year} {year + 1} {year + 2} {year + 3}", f"{year}{month:02}{day:02}"])
    gap = chance.choice([" ", "-", ".", "/", " ", "."])
    return gap.join(number(chance.choice([1, 2, 2, 3, 3, 4, 4, 5, 6, 8, 12, 16]))
                    for _ in range(chance.randint(1, 6)))


def _lessons(rows: list[tuple[str, str, int, int]], how: Training
             ) -> list[tuple[list[Candidate], dict[tuple[int, int], int]]]:
    """Candidates of a text each, and the kinds of those that are right."""
    chance = random.Random(how.seed)
    spans = [(kind, text[a:b]) for kind, text, a, b in rows if kind != "none"]
    out = []

    def learn(parts: list[tuple[str, str]]) -> None:
        text, right = "", {}
        for kind, said in parts:
            if kind in KINDS:
                right[len(text), len(text) + len(said)] = KINDS.index(kind) + 1
            text += said
        found = list(candidates(text))
        if found and right.keys() <= {(c.start, c.end) for c in found}:
            out.append((found, right))

    for kind, text, a, b in rows:
        before, said, after = ("", text[:a]), text[a:b], ("", text[b:])
        if kind == "none":
            learn([("", text)])
            continue
        learn([before, (kind, said), after])
        before = ("", text[:a] + chance.choice(["", "", "", ": ", "(", '"', "<"]))
        after = ("", chance.choice(["", "", "", ".", ",", ";", ")", ".\n"]) + text[b:])
        learn([before, (kind, _respelled(kind, said, chance)), after])
        other, beside = chance.choice(spans)
        if chance.random() < 0.5:
            beside = _respelled(other, beside, chance)
        gap = ("", chance.choice([" ", " ", ", ", " / "]))
        learn([before, (kind, said), gap, (other, beside), after])
        learn([before, (kind, said), gap, ("", _look_alike("card", "0" * 16, "", chance)[:4]), after])
        for _ in range(3):
            learn([before, ("", _look_alike(kind, said, text[:a] + text[b:], chance)), after])
    return out


def _expected(score: np.ndarray, start: np.ndarray, end: np.ndarray, points: int, follows: np.ndarray
              ) -> tuple[float, np.ndarray, np.ndarray]:
    """The log of the sum over all covers, and how often each (segment, kind) and each pair of touching
    kinds occurs in one, by going forward and backward over the points."""
    size = len(KINDS) + 1
    ahead = np.full((points, size), -np.inf)
    ahead[0, 0] = 0.0
    by_start = [[] for _ in range(points)]
    for i, s in enumerate(start.tolist()):
        by_start[s].append(i)
    entering = np.empty((len(start), size - 1))
    for p in range(points):
        if p:
            ahead[p, 0] = np.logaddexp(ahead[p, 0], np.logaddexp.reduce(ahead[p - 1]))
        if by_start[p]:
            into = np.logaddexp.reduce(ahead[p][:, None] + follows[:, 1:], axis=0)
            for i in by_start[p]:
                entering[i] = into
                ahead[end[i], 1:] = np.logaddexp(ahead[end[i], 1:], into + score[i])
    total = np.logaddexp.reduce(ahead[-1])
    behind = np.full((points, size), -np.inf)
    behind[-1] = 0.0
    touching = np.zeros((size, size))
    for p in range(points - 1, -1, -1):
        if p < points - 1:
            behind[p] = behind[p + 1, 0]
        for i in by_start[p]:
            leaving = follows[:, 1:] + (score[i] + behind[end[i], 1:])[None, :]
            touching[:, 1:] += np.exp(ahead[p][:, None] + leaving - total)
            behind[p] = np.logaddexp(behind[p], np.logaddexp.reduce(leaving, axis=1))
    each = np.exp(entering + score + behind[end, 1:] - total)
    return float(total), each, touching


def _compile(lessons, names: dict[str, int]):
    """Lessons as numbers: feature numbers of candidates, their first and last points, right answers."""
    out = []
    for found, right in lessons:
        points = sorted({0, *(c.start for c in found), *(c.end for c in found)})
        place = {p: i for i, p in enumerate(points)}
        features = [np.array([names[f] for f in c.features if f in names]) for c in found]
        gold = np.zeros((len(found), len(KINDS)))
        for i, c in enumerate(found):
            kind = right.get((c.start, c.end))
            if kind:
                gold[i, kind - 1] = 1
        start = np.array([place[c.start] for c in found])
        end = np.array([place[c.end] for c in found])
        touching = np.zeros((len(KINDS) + 1,) * 2)
        ended = {}
        for i in np.flatnonzero(gold.any(axis=1)).tolist():
            kind = int(gold[i].argmax()) + 1
            touching[ended.get(int(start[i]), 0), kind] += 1
            ended[int(end[i])] = kind
        out.append((features, start, end, len(points), gold, touching))
    return out


def train(rows: list[tuple[str, str, int, int]], how: Training = Training()) -> Model | None:
    """The weights that make the right covers likeliest, by stochastic gradient steps; None without
    any span to learn from. ``rows``: kind or ``none``, text, start and end of the span."""
    rows = sorted(set(rows))
    if not any(kind in KINDS for kind, *_ in rows):
        return None
    lessons = _lessons(rows, how)
    seen = Counter(f for found, _ in lessons for c in found for f in c.features)
    names = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n > 1))}
    compiled = _compile(lessons, names)
    weight = np.zeros((len(names), len(KINDS)))
    follows = np.zeros((len(KINDS) + 1,) * 2)
    square, follows_square = np.full(weight.shape, 1e-2), np.full(follows.shape, 1e-2)
    order = np.random.default_rng(how.seed)
    learned = np.zeros(len(KINDS), bool)
    for _, _, _, _, gold, _ in compiled:
        learned |= gold.any(axis=0)
    for _ in range(how.epochs):
        for i in order.permutation(len(compiled)).tolist():
            features, start, end, points, gold, touching = compiled[i]
            score = np.array([weight[f].sum(axis=0) for f in features])
            score[:, ~learned] = _NEVER
            _, each, met = _expected(score, start, end, points, follows)
            error = gold - each
            for f, e in zip(features, error, strict=True):
                if np.abs(e).max() > 1e-4:
                    g = e - how.shrink * weight[f]
                    square[f] += g * g
                    weight[f] += how.rate * g / np.sqrt(square[f])
            g = (touching - met) - how.shrink * follows
            g[0, 1:] = 0  # a segment after plain text has no score besides its features
            follows_square += g * g
            follows += how.rate * g / np.sqrt(follows_square)
    weight[:, ~learned] = -1e3
    return Model({f: weight[i] for f, i in names.items()}, follows)


# --- as table jobs ---------------------------------------------------------------------------------

def _held(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Rows, with their texts, that may hold something."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    may = pc.fill_null(pc.match_substring_regex(column, MAY_HOLD), False)
    for row in np.flatnonzero(may.to_numpy(zero_copy_only=False)).tolist():
        yield row, column[row].as_py()


def _stretches(text: str, reach: int) -> Iterator[tuple[str, str, int, int]]:
    """Rule finds with what stands around them, and one stretch without any; never two finds at once,
    as a find within reach of another would be taken for plain text."""
    base = base_spans(text)
    for k, span in enumerate(base):
        low = max(span.start - reach, base[k - 1].end if k else 0, 0)
        high = min(span.end + reach, base[k + 1].start if k + 1 < len(base) else len(text))
        if low <= span.start and high >= span.end and span.end - span.start <= 80:
            yield span.kind, text[low:high], span.start - low, span.end - low
    fixed, k = [(s.start - 2, s.end + 2) for s in base], 0
    for c in candidates(text):
        while k < len(fixed) and fixed[k][1] <= c.start - reach:
            k += 1
        # Only where rules had no part: what they spoiled between neighbours is not "none".
        if (k == len(fixed) or fixed[k][0] >= c.end + reach) and c.features[0] == "number" and (
                "check True" not in c.features and "octets True d" not in c.features
                and "+" not in text[max(c.start - 2, 0) : c.end]):
            low, high = max(c.start - reach, 0), min(c.end + reach, len(text))
            if not any("check True" in x.features for x in candidates(text[low:high])):
                yield "none", text[low:high], c.start - low, c.end - low
            return


def training_windows(documents: DataFrame, how: Training, text_col: str = "text"
                     ) -> list[tuple[str, str, int, int]]:
    """At most ``how.windows`` different stretches per kind, those that a hash puts first, from all
    rows. Batches hand on no more than that each."""
    schema = "kind string, text string, start int, stop int"

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {x for _, text in _held(batch.column(0)) for x in _stretches(text, how.reach)}
            kept: Counter = Counter()
            rows = []
            for row in sorted(found, key=lambda x: (zlib.crc32(x[1].encode()), x)):
                kept[row[0]] += 1
                if kept[row[0]] <= how.windows:
                    rows.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.string(), pa.string(), pa.int32(), pa.int32()))],
                ["kind", "text", "start", "stop"])

    order = Window.partitionBy("kind").orderBy(F.crc32(F.encode("text", "UTF-8")), "text", "start", "stop")
    chosen = materialize(
        in_small_batches(documents.select(F.col(text_col).cast("string").alias("text")))
        .mapInArrow(pick, schema).distinct()
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.windows)
        .drop("rank"))
    return [tuple(r) for r in chosen.collect()]


def find(documents: DataFrame, how: Training = Training(), text_col: str = "text", margin: float = 1.0,
         learn_from: DataFrame | None = None, redact: bool = False) -> DataFrame:
    """``documents`` with ``pii``: an array of ``kind, start, end, by_rule``, by start, then kind.

    Positions count code points. Rule finds always stay; the model adds segments that overlap none of
    them and beat plain text by ``margin``. It learns from ``learn_from``, by default from the
    documents themselves; without any rule find in there it adds nothing. ``redact`` adds
    ``redacted``, the text with each span replaced by its kind in angle brackets.

    Null and empty texts have no spans; redacted they stay as they are. Rows do not meet each other, so
    repeated rows and ids get the same answer. Columns of the added names are replaced.
    """
    model = train(training_windows(documents if learn_from is None else learn_from, how, text_col), how)
    added = ["pii", "redacted"] if redact else ["pii"]
    base = in_small_batches(documents).drop(*added)
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    kind = "array<struct<kind:string,start:bigint,end:bigint,by_rule:boolean>>"
    schema = ", ".join([f"`{c}` {t}" for c, t in types.items()] + [f"pii {kind}"] + (
        ["redacted string"] if redact else []))
    arrow_kind = pa.list_(pa.struct([
        ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("by_rule", pa.bool_())]))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            rows: list[list] = [[]] * len(texts)
            clean = texts.to_pylist() if redact else None
            for row, text in _held(texts):
                rules = base_spans(text)
                more = added_spans(text, rules, model, margin) if model else []
                marked = sorted([(s, True) for s in rules] + [(s, False) for s in more],
                                key=lambda x: _order(x[0]))
                rows[row] = [{"kind": s.kind, "start": s.start, "end": s.end, "by_rule": by}
                             for s, by in marked]
                if redact:
                    clean[row] = without(text, [s for s, _ in marked])
            columns = [*batch.columns, pa.array(rows, arrow_kind)]
            yield pa.RecordBatch.from_arrays(
                columns + ([pa.array(clean, pa.string())] if redact else []),
                [*batch.schema.names, *added])

    return base.mapInArrow(label, schema)


def without(text: str, spans: list[Span]) -> str:
    """The text with its spans replaced by their kinds; of overlapping ones the first gives the name."""
    out, at = [], 0
    for span in spans:
        if span.start >= at:
            out += [text[at : span.start], f"<{span.kind}>"]
        at = max(at, span.end)
    return "".join(out) + text[at:]


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",")


def rules_sql() -> str:
    """What the rules find per row of ``documents`` as SQL: counts and digest."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    doubled = ("list_sum(list_transform(range(1, len(d) + 1), lambda i:"
               " CASE WHEN i % 2 = 1 THEN CAST(d[len(d) + 1 - i] AS INTEGER)"
               " ELSE (CAST(d[len(d) + 1 - i] AS INTEGER) * 2) % 10"
               " + (CAST(d[len(d) + 1 - i] AS INTEGER) * 2) // 10 END))")
    keep = {
        "email": "TRUE",
        "ip": "list_max(list_transform(string_split(said, '.'), lambda x: CAST(x AS HUGEINT))) <= 255",
        "card": f"len(d) BETWEEN 14 AND 19 AND {doubled} % 10 = 0",
        "phone": "len(d) BETWEEN 10 AND 15",
    }
    found = "\n  UNION ALL ".join(f"""
  SELECT doc_id, {k} AS place, '{kind}' AS kind, said, start, regexp_replace(said, '[^0-9]', '', 'g') AS d,
    CASE WHEN {keep[kind]} THEN TRUE ELSE FALSE END AS good
  FROM (SELECT doc_id, said, start, regexp_replace(said, '[^0-9]', '', 'g') AS d FROM (
    SELECT doc_id, ms[i] AS said, CAST(
      list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS ms,
        regexp_split_to_array(text, '{p}') AS gaps
      FROM documents WHERE text IS NOT NULL), unnest(range(1, len(ms) + 1)) AS t(i)))"""
        for k, (kind, p) in enumerate(patterns.items()))
    counts = ", ".join(
        f"count(*) FILTER (kind = '{kind}' AND good) AS n_{kind}" for kind in KINDS)
    return f"""
WITH found AS ({found}),
told AS (
  SELECT doc_id, {counts}, string_agg(kind || ':' || start || ':' || (start + length(said)), ','
    ORDER BY start, place) FILTER (good) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in KINDS)},
  sha256(coalesce(spans, '')) AS base_sha256
FROM documents LEFT JOIN told USING (doc_id)"""
