"""Personal data by a semi-Markov conditional random field.

Base patterns find plain e-mail addresses, IP addresses, card numbers and telephone numbers. The model adds those that are
written otherwise ("jane at mail dot com", "10[.]0[.]0[.]7", "(743) 555-0199", "4111.1111.1111.1111"). The text is cut into
tokens; every run of up to MOST_TOKENS tokens and SPAN characters that meets a kind's hard conditions is a candidate segment,
scored by features of the whole span and its surroundings. Dynamic programming over segments of bounded length then chooses
boundaries and kinds jointly; all else is single-token "other" segments. Each candidate holds one of the places that GATES
find, so only the text within SPAN of such places is looked at; elsewhere all tokens are "other". Weights come from
maximising the conditional likelihood of seeded synthetic sentences, so they are the same everywhere.

Defined cases: a null text is an empty one and has no spans; whole texts are read, however long; spans of the model that
overlap a base span are left out, base spans never are; rows with equal ids or texts are treated each; an empty table gives
an empty result; other columns have no part in it. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches

Span = tuple[str, int, int]

# The kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match that starts within a run of digits would have started before it
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

#: Bounds of a segment: a card written digit by digit has 37 tokens, an address of the longest local part and a usual domain 120 characters.
MOST_TOKENS, SPAN = 40, 160
# Every candidate of a number has a match of the first, every candidate of an address one of the second.
GATES = (re.compile(rf"[0-9(+][0-9\s().\-/\[\]]{{5,{SPAN}}}[0-9]"), re.compile(r"@|[\[({]\s*(?:at|dot|\.)\s*[\])}]|\sdot\s", re.IGNORECASE))
# Words that announce a telephone number, and common top-level domains.
CUES = frozenset("call phone telephone tel mobile cell fax dial ring text contact reach number whatsapp sms hotline".split())
DOMAINS = frozenset("com org net edu gov mil int info biz io co me tv us ca uk ie de at ch fr es pt it nl be dk se no fi pl cz ru ua jp cn in au nz br mx eu".split())
TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def base_spans(text: str) -> list[Span]:
    """The base patterns' matches that hold, by start, then kind."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


# -- the model

MARK_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+|\s*@\s*", re.IGNORECASE)
MARK_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+", re.IGNORECASE)
WHOLE_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
WHOLE_IP = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
NUMBER = re.compile(r"[0-9+(][0-9 ().\-/]*[0-9]")


def number_kinds(span: str, n: int) -> list[str]:
    """The kinds whose hard conditions a span of n digits, spaces and marks meets."""
    out = []
    if 4 <= n <= 19:
        if 10 <= n <= 15 and NUMBER.fullmatch(span):
            out.append("phone")
        if 14 <= n <= 19 and "(" not in span and "+" not in span and NUMBER.fullmatch(span) and luhn(_digits(span)):
            out.append("card")
        if 4 <= n <= 12 and "." in span:
            plain = re.sub(r"\s*[\[(]?\s*\.\s*[\])]?\s*", ".", span)
            if WHOLE_IP.fullmatch(plain) and all(int(p) <= 255 for p in plain.split(".")):
                out.append("ip")
    return out


def kinds_of(span: str) -> list[str]:
    """The kinds whose hard conditions the whole span meets."""
    out = []
    n = len(_digits(span))
    if n == len(re.sub(r"[\s().\-/+\[\]]", "", span)):
        return number_kinds(span, n)
    if len(marks := MARK_AT.findall(span)) == 1 and span[0].isalnum() and span[-1].isalpha():
        plain = MARK_DOT.sub(".", MARK_AT.sub("@", span))
        if WHOLE_EMAIL.fullmatch(plain) and plain != span and (marks[0].strip().lower() != "at" or MARK_DOT.search(span)):
            out.append("email")
    return out


NINES = str.maketrans("012345678", "9" * 9)


def _shape(span: str) -> str:
    shape = span.translate(NINES)
    return shape if shape.isascii() and shape.lower() == shape.upper() else re.sub(r"[^\W\d_]+", "a", shape)


def features(kind: str, span: str, before: str, tokens: int, cue: str = "", joined: bool = False, beside: str = "") -> list[str]:
    """Features of a whole segment of a kind: of itself, the token and the last word before it, whether digits go on beside it, and the runs of digits around it on its line; kind "other" has single tokens."""
    if kind == "other":
        long = min(len(span), 20) if span[0].isdigit() else 0
        return [f"o:digits={long}", f"o:mark={span if not span[0].isalnum() else 'w'}"]
    shape, n = _shape(span), len(_digits(span))
    marks = "".join(sorted(set(re.sub(r"[^\W_]", "", span))))
    return [
        kind,
        f"{kind}:n={n if kind != 'email' else 0}",
        f"{kind}:marks={marks}",
        f"{kind}:shape={shape if kind != 'email' else shape[:12]}",
        f"{kind}:runs={len(re.findall('9+', shape)) if kind != 'email' else 0}",
        f"{kind}:tokens={tokens}",
        f"{kind}:before={'9' if before.isdigit() else 'w' if before.isalnum() else before or '^'}",
        f"{kind}:cue={cue.lower() in CUES}:{shape if kind == 'phone' else ''}",
        *([f"email:domain={span.rpartition('.')[2].split()[-1].strip('])} ').lower() in DOMAINS}:{'dot' if re.search(r'[a-z] +dot +[a-z]', span, re.IGNORECASE) else ''}"] if kind == "email" else []),
        f"{kind}:start={shape[0]}",
        f"{kind}:joined={joined}",
        f"{kind}:beside={beside}",
        f"{kind}:beside={beside}:{cue.lower() in CUES}:{shape[0]}",
    ]


def _beside(text: str, start: int, end: int) -> str:
    """How many runs of digits stand before and behind a span, on its line and within NEAR characters, up to two each."""
    left, right = text[max(0, start - NEAR) : start].rpartition("\n")[2], text[end : end + NEAR].partition("\n")[0]
    return f"{min(2, len(RUN.findall(left)))}{min(2, len(RUN.findall(right)))}"


def _plain_features(kind: str, text: str, a: int, b: int, before: str, tokens: int, cue: str, joined: bool) -> list[str]:
    """What a segment is learned from."""
    return features(kind, text[a:b], before, tokens, cue, joined, _beside(text, a, b))


#: Characters around a span in which runs of digits are counted.
NEAR = 24
RUN = re.compile(r"[0-9]+")
Segment = tuple[int, int, str, object]


def segment_rows(text: str, tokens: list[tuple[int, int]], weigh=_plain_features) -> Iterator[list[Segment]]:
    """By its end, from one token on: the candidate segments (first token, end, kind, what `weigh` makes of it).

    Rows come as soon as all segments with their end are known, so that no more than MOST_TOKENS of them are held.
    """
    rows: deque[list[Segment]] = deque([[] for _ in range(MOST_TOKENS + 1)])
    n = len(tokens)
    word = lambda i: text[tokens[i][0] : tokens[i][1]] if 0 <= i < n else ""
    # digits right beside a segment, or behind a mark that joins them to it
    goes_on = lambda i, k: word(i).isdigit() or word(i) in ("-", "/", ".", "+") and word(k).isdigit()
    ats = deque(i for i, (a, b) in enumerate(tokens) if b - a <= 2 and text[a:b].lower() in ("@", "at"))
    for i, (a, _) in enumerate(tokens):
        first_word, before = word(i), word(i - 1)
        rows[0].append((i, i + 1, "other", weigh("other", text, a, tokens[i][1], before, 1, "", False)))
        first = first_word[0]
        while ats and ats[0] <= i:
            ats.popleft()
        at = ats[0] if ats else n + MOST_TOKENS
        number = first in "+(0123456789"
        if number or (first.isalnum() and at < i + MOST_TOKENS):
            cue = before if before.isalnum() else word(i - 2)
            left, digits, dots = None, 0, 0
            for j in range(i + 1, min(n, i + MOST_TOKENS) + 1):
                c, d = tokens[j - 1]
                if d - a > SPAN or j - i > 1 and c - tokens[j - 2][1] > 2:
                    break
                last = text[c:d]
                if number and not (last.isdigit() and last.isascii() or last in "+().-/[]"):
                    number = False
                    if at >= i + MOST_TOKENS:
                        break
                if number:
                    if not last.isdigit():
                        dots += last == "."
                        continue
                    digits += d - c
                    if digits > 19 and at >= i + MOST_TOKENS:
                        break  # more than any kind has
                    if digits < 10 and dots != 3:
                        continue
                    found = number_kinds(text[a:d], digits)
                elif at < j - 1 and last[-1].isalpha():
                    found = kinds_of(text[a:d])
                else:
                    continue
                for kind in found:
                    left = goes_on(i - 1, i - 2) if left is None else left
                    rows[j - i - 1].append((i, j, kind, weigh(kind, text, a, d, before, j - i, cue, left or goes_on(j, j + 1))))
        yield rows.popleft()
        rows.append([])


def segments(text: str, tokens: list[tuple[int, int]]) -> list[list[Segment]]:
    """All rows of a short text, with their features; there is none before the first token."""
    return [[], *segment_rows(text, tokens)]


LABELS = ("other", *KINDS)
#: Scores that are kept at once.
KNOWN = 200_000


class SemiCrf:
    def __init__(self) -> None:
        self.w: dict[str, float] = defaultdict(float)

    def _score(self, s: Segment) -> float:
        get = self.w.get
        return sum([get(f, 0.0) for f in s[3]])

    def weigher(self):
        """The score of a segment as it comes, kept by all that its features depend on."""
        known: dict[tuple, float] = {}
        get = self.w.get

        def weigh(kind: str, text: str, a: int, b: int, before: str, tokens: int, cue: str, joined: bool) -> float:
            span = text[a:b]
            if kind == "other":
                key = ("other", min(b - a, 20) if span[0].isdigit() else 0, span if not span[0].isalnum() else "w")
            else:
                kept = span if kind == "email" else _shape(span)
                key = (kind, kept, "9" if before.isdigit() else "w" if before.isalnum() else before, tokens, cue.lower() in CUES, joined, _beside(text, a, b))
            if (score := known.get(key)) is None:
                if len(known) > KNOWN:
                    known.clear()
                own = features(kind, span, before, tokens, cue, joined, key[-1] if kind != "other" else "")
                score = known[key] = sum([get(f, 0.0) for f in own])
            return score

        return weigh

    def best(self, rows: Iterator[list[Segment]], n: int) -> list[tuple[int, int, str]]:
        """The segments of the best segmentation that are of a kind, by dynamic programming over (end, kind of the last segment).

        Of the values only the last MOST_TOKENS ends are held; what leads back is two bytes for each end and kind.
        """
        link = {(b, k): self.w.get(f"{b}>{k}", 0.0) for b in ("^", *LABELS) for k in LABELS}
        place = {k: i for i, k in enumerate(LABELS)}
        lengths, befores = bytearray(len(LABELS) * (n + 1)), bytearray(len(LABELS) * (n + 1))
        top: deque[dict[str, float]] = deque([{"^": 0.0}], MOST_TOKENS)
        for j, row in enumerate(rows, 1):
            found: dict[str, tuple[float, int, str]] = {}
            for i, _, kind, own in row:
                for before, v in top[i - j].items():
                    v += own + link[before, kind]
                    if kind not in found or v > found[kind][0]:
                        found[kind] = (v, j - i, before)
            for kind, (_, length, before) in found.items():
                at = j * len(LABELS) + place[kind]
                lengths[at], befores[at] = length, place.get(before, 0)
            top.append({k: v for k, (v, _, _) in found.items()})
        out, j = [], n
        kind = max(top[-1], key=lambda k: (top[-1][k], k)) if n else ""
        while j:
            at = j * len(LABELS) + place[kind]
            i, before = j - lengths[at], LABELS[befores[at]]
            if kind != "other":
                out.append((i, j, kind))
            j, kind = i, before
        return out[::-1]

    def learn(self, ends: list[list[Segment]], gold: list[Segment], rate: float) -> None:
        """One step up the log-likelihood: features of the gold segmentation less those expected under the model."""
        w = self.w
        n = len(ends) - 1
        alpha: list[dict[str, float]] = [{"^": 0.0}, *({} for _ in range(n))]
        scored = [[(s, self._score(s)) for s in row] for row in ends]
        for j in range(1, n + 1):
            sums: dict[str, list[float]] = defaultdict(list)
            for s, own in scored[j]:
                sums[s[2]] += [a + own + w.get(f"{k}>{s[2]}", 0.0) for k, a in alpha[s[0]].items()]
            alpha[j] = {k: _log_sum(v) for k, v in sums.items()}
        beta: list[dict[str, list[float]]] = [defaultdict(list) for _ in range(n + 1)]
        after: list[dict[str, float]] = [{} for _ in range(n + 1)]
        after[n] = dict.fromkeys(alpha[n], 0.0)
        z = _log_sum(list(alpha[n].values()))
        step: dict[str, float] = defaultdict(float)
        for j in range(n, 0, -1):
            if j < n:
                after[j] = {k: _log_sum(v) for k, v in beta[j].items()}
            for s, own in scored[j]:
                if s[2] not in after[j]:
                    continue
                total = 0.0
                for k, a in alpha[s[0]].items():
                    link = own + w.get(f"{k}>{s[2]}", 0.0) + after[j][s[2]]
                    beta[s[0]][k].append(link)
                    p = math.exp(min(0.0, a + link - z))
                    total += p
                    step[f"{k}>{s[2]}"] -= p
                for f in s[3]:
                    step[f] -= total
        before = "^"
        for s in gold:
            step[f"{before}>{s[2]}"] += 1
            for f in s[3]:
                step[f] += 1
            before = s[2]
        for f, v in step.items():
            w[f] += rate * (v - 0.002 * w[f])


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum([math.exp(v - top) for v in values]))


# -- synthetic sentences


def _card(r: random.Random) -> str:
    body = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if luhn(body + d))


def _sentence(r: random.Random) -> tuple[str, list[Span]]:
    word = lambda: "".join(r.choice("abcdehilmnorstu") for _ in range(r.randint(2, 9)))
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: r.choice([word(), f"{word()}.{word()}", f"{word()}{number(2)}", f"{word()}.{number(2)}"])
    end_of = lambda: r.choice(["com", "com", "org", "net", r.choice(sorted(DOMAINS))])
    host = lambda: r.choice([[word(), end_of()], [word(), word(), end_of()], [word() + number(1), end_of()], [word(), "co", "uk"]])
    parts: list[tuple[str, str]] = []
    cues = sorted(CUES)
    for _ in range(r.randint(1, 2)):
        parts += [(word(), "") for _ in range(r.randint(1, 4))]
        what = r.randrange(25)
        area, mid, end = str(r.randint(2, 9)) + number(2), number(3), number(4)
        if what == 0:
            parts.append((f"{name()}{r.choice([' at ', ' [at] ', '(at)', '[at]', ' (at) ', ' AT '])}{r.choice([' dot ', ' [dot] ', '(dot)', ' (dot) ', ' DOT ']).join(host())}", "email"))
        elif what == 1:
            parts.append((f"{name()}{r.choice(['[at]', '(at)', ' [at] ', ' @ ', '{at}'])}{'.'.join(host())}", "email"))
        elif what == 2:
            parts.append((r.choice(["[.]", " . ", "(.)"]).join(str(r.randint(0, 255)) for _ in range(4)), "ip"))
        elif what == 3:
            parts.append((r.choice([".", "/", " / "]).join(re.findall("....", _card(r))), "card"))
        elif what in (4, 5):
            parts.append((r.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}", "1-{}-{}-{}", "({}) {} {}"]).format(area, mid, end), "phone"))
        elif what == 6:
            parts += [(r.choice(cues) + r.choice(["", "", ":", "."]), ""), (r.choice(["{}{}{}", "{} {} {}", "0{} {}{}", "({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(area, mid, end), "phone")]
        elif what == 7:
            parts.append((f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)} {r.randint(10, 23)}:{number(2)}", ""))
        elif what == 8:
            parts.append((r.choice([number(r.randint(10, 15)), f"id {number(12)}", f"no. {number(11)}", f"{number(4)} {number(4)} {number(4)}"]), ""))
        elif what == 9:
            parts.append((r.choice([f"{number(3)}.{number(3)}.{number(3)}", f"{number(2)} {number(2)} {number(3)} {number(1)} {number(4)}", f"{number(5)}-{number(6)}", f"{number(1)}.{number(9)}"]), ""))
        elif what == 10:
            parts.append((f"{word()} at {word()} {word()}", ""))
        elif what == 11:
            parts.append((f"{number(3)}/{number(4)}/{number(3)}/{number(4)}", ""))
        elif what == 12:
            parts.append((f"{word()} dot {word()}", ""))
        elif what == 13:
            parts += [(r.choice([word(), "order", "account", "item", "ref"]) + r.choice(["", ":", " no."]), ""), (r.choice([area + mid + end, f"{area} {mid} {end}", f"0{area} {mid}{end}", number(10), number(12)]), "")]
        elif what == 14:
            parts.append((r.choice([f"{area}-{mid}-{end}-{number(2)}", f"{number(2)}-{area}-{mid}-{end}-{number(3)}", f"{area}.{mid}.{end}.{number(3)}.{number(2)}", f"{number(3)}/{area}-{mid}-{end}"]), ""))
        elif what == 15:
            parts.append((r.choice([f"{name()} at {r.choice(['the ', ''])}{word()} dot {word()} {word()}", f"{number(3)}-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"{number(1)}-{number(4)}-{number(4)}-{number(1)}"]), ""))
        elif what == 16:
            parts.append((r.choice([" . ", ". ", " - ", "/"]).join(_card(r)), "card"))
        elif what == 17:
            parts.append((r.choice([f"{number(1)}.{number(1)}.{number(2)}", f"v{number(1)}.{number(1)}.{number(1)}.{number(1)}", f"{number(3)} . {number(3)}", f"[{number(1)}] [{number(1)}] [{number(2)}]", f"{number(1)}.{number(1)}[.]{number(1)}"]), ""))
        elif what in (18, 19):
            mark, most = r.choice([" ", " ", "  ", "\t", ", ", "; ", " | ", ".", "-"]), r.choice([1, 1, 2, 3, 4, 4, 5, 6])
            parts.append((mark.join(number(r.randint(1, most)) for _ in range(r.randint(5, 24))), ""))
        elif what == 20:
            parts.append((r.choice([f"{r.randint(1990, 2030)} {number(3)} {number(3)} {number(4)}", f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)} {number(3)} {number(4)} {number(2)}", f"{number(2)}:{number(2)}:{number(2)},{number(3)} INFO {number(4)} {number(4)} {number(3)}", f"{number(4)}\t{number(4)}\t{number(4)}\t{number(4)}", " ".join(str(r.randint(1990, 2030)) for _ in range(r.randint(3, 6)))]), ""))
        elif what == 21:
            parts.append((r.choice([f"{number(4)} {number(4)} {number(4)} {number(4)}", f"{number(3)} {number(3)} {number(4)} {number(4)}", f"{number(4)} {number(3)} {number(4)}", f"{number(2)} {number(4)} {number(4)} {number(2)}", f"{area} {mid} {end}"]), ""))
        elif what == 22:
            parts += [(number(r.randint(1, 3)), ""), (r.choice([word(), word() + ","]), ""), (r.choice(["({}) {}-{}", "{}-{}-{}"]).format(area, mid, end), "phone"), (r.choice([word(), number(2), ""]), "")]
        elif what == 23:
            parts.append((" ".join(f"{number(r.randint(1, 3))}.{number(r.randint(1, 3))}" for _ in range(r.randint(3, 9))), ""))
        else:
            parts.append((r.choice([f"{number(4)}, {number(4)}, {number(4)}", f"{number(3)} + {number(4)} + {number(4)}", f"{number(2)}/{number(2)}/{number(4)} {number(4)}"]), ""))
        parts += [(word(), "") for _ in range(r.randint(0, 3))]
    text, spans = "", []
    for part, kind in parts:
        text += " " if text else ""
        if kind:
            spans.append((kind, len(text), len(text) + len(part)))
        text += part + r.choice(["", "", "", ",", "."]) * (not kind)
    return text, spans


@lru_cache(1)
def trained(sentences: int = 1500, rounds: int = 6, seed: int = 11) -> SemiCrf:
    """The model after `rounds` passes over `sentences` seeded synthetic sentences."""
    r, model, data = random.Random(seed), SemiCrf(), []
    for _ in range(sentences):
        text, spans = _sentence(r)
        tokens = [m.span() for m in TOKEN.finditer(text)]
        ends = segments(text, tokens)
        gold, i = [], 0
        starts = {a: (k, b) for k, a, b in spans}
        while i < len(tokens):
            kind, end = starts.get(tokens[i][0], ("other", tokens[i][1]))
            s = next((s for row in ends[i + 1 :] for s in row if s[0] == i and s[2] == kind and tokens[s[1] - 1][1] == end), None)
            s = s or next(s for s in ends[i + 1] if s[2] == "other")
            gold.append(s)
            i = s[1]
        data.append((ends, gold))
    for k in range(rounds):
        r.shuffle(data)
        for ends, gold in data:
            model.learn(ends, gold, 0.3 / (1 + k))
    model.w = {f: v for f, v in model.w.items() if abs(v) > 1e-4}
    return model


def _areas(text: str) -> list[tuple[int, int]]:
    """What lies within SPAN of a gate, without cutting tokens; disjoint, by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted([m.span() for gate in GATES for m in gate.finditer(text)]):
        a, b = max(0, a - SPAN), min(len(text), b + SPAN)
        if out and a <= out[-1][1]:
            a = out.pop()[0]
        else:
            while 0 < a and text[a - 1].isalnum() and text[a].isalnum():
                a -= 1
        while b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
            b += 1
        if out and a <= out[-1][1]:
            a = out.pop()[0]
        out.append((a, b))
    return out


def added_spans(text: str, model: SemiCrf, areas: list[tuple[int, int]] | None = None, weigh=None) -> list[Span]:
    """The model's spans over the whole text, or over given areas of it."""
    out: list[Span] = []
    weigh = weigh or model.weigher()
    for a, b in _areas(text) if areas is None else areas:
        tokens = [m.span() for m in TOKEN.finditer(text, a, b)]
        out += [(kind, tokens[i][0], tokens[j - 1][1]) for i, j, kind in model.best(segment_rows(text, tokens, weigh), len(tokens))]
    return out


def find(text: str, model: SemiCrf, weigh=None) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: those of the model that overlap none of the base."""
    base = base_spans(text)
    starts, ends = [s[1] for s in base], list(accumulate((s[2] for s in base), max))
    more = [s for s in added_spans(text, model, None, weigh) if not (k := bisect_left(starts, s[2])) or ends[k - 1] <= s[1]]
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans and n_spans (all spans) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(dict(trained().w))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = SemiCrf()
        crf.w = model.value
        weigh = crf.weigher()
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in batch.column(1):
                base, spans = find(text.as_py(), crf, weigh)
                for i, kind in enumerate(KINDS):
                    out[i].append(sum([s[0] == kind for s in base]))
                out[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[5].append(joined(spans))
                out[6].append(len(spans))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds)], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    return in_small_batches(rows).mapInArrow(run, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])
