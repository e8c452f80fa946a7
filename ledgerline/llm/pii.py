"""Personal data: base patterns plus a semi-Markov conditional random field over what they miss.

Base spans follow fixed patterns.  The field then looks at the text between them: it scores whole candidate segments
(digits, groups, separators, checksum, domain shape, surroundings) for each kind, and a dynamic programme over segments
of bounded length picks boundaries and kinds together.  Between places with a digit or an at-sign no segment can
start, so the programme splits exactly into short stretches of text.

Weights are trained here, by the likelihood of whole segmentations on generated text: spans of each kind in regular and
disguised spelling ("name at mail dot org", numbers without a plus, cards cut by dots), and look-alikes that are
none (versions, dates, prices, hashes, long identifiers).  Training takes nothing from the corpus.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clear_text, per_row

#: Kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that starts inside a run of digits would also start at the run's first digit, so looking behind changes nothing.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of local part, at-sign, domain; in one pass, also over very long runs of letters."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_LETTERS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind as in KINDS, then by start."""
    out = emails(text)
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if octets(m.group())]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


# ---- the semi-Markov field

TOKEN = re.compile(r"[^\W_]+|\s+|[\W_]")
TRIGGER = re.compile(r"[0-9@＠]|[\[({<]\s*at\s*[\])}>]|(?<=[^\W_])\s+at\s+(?=[^\W_]+(?:\.[^\W_]{2}|\s+dot\s|\s*[\[({<]\s*dot))", re.IGNORECASE)
#: Tokens of the longest segment, and of text taken in on each side of a place where a segment may be.
LONGEST, MARGIN = 24, 12
AT = re.compile(r"\s*(?:@|＠|[\[({<]\s*at\s*[\])}>]|\s+at\s+)\s*", re.IGNORECASE)
DOT = re.compile(r"\s*(?:[\[({<]\s*dot\s*[\])}>]|\s+dot\s+)\s*", re.IGNORECASE)
BARE_AT = re.compile(r"\s+at\s+", re.IGNORECASE)
HOST = re.compile(r"[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,}", re.IGNORECASE)
SHAPES = [
    "bias", "mail_shape", "mail_disguised", "dirty_ends", "four_parts", "octets", "disguised_parts", "digits_7", "digits_8_15", "digits_16_19",
    "luhn", "plus", "grouped", "card_groups", "brackets", "other_letters", "glued", "one_run", "long_part", "phone_cue", "card_cue", "ip_cue", "odd_separator",
    "doubled_separator", "mail_goes_on", "number_goes_on", "bare_at", "local_dots",
]
#: Endings after which a bare "at" with plain dots is taken for an address more readily than for a sentence's end.
COMMON_ENDINGS = frozenset("com org net edu gov io co info eu de fr es uk us it nl ch at be pl se jp cn in br ca au example".split())
NUMBER_SIGNS = frozenset("0123456789+().-/·_ [{]}")
MAIL_ON = re.compile(r"(?:\.|\s*[\[({<]\s*dot\s*[\])}>]\s*|\s+dot\s+)[a-z0-9]{2,}", re.IGNORECASE)
NUMBER_ON, NUMBER_FROM = re.compile(r"[ .()/-]{0,2}[0-9]"), re.compile(r"[0-9+][ .()/-]{0,2}$")
CUES = {
    "phone_cue": re.compile(r"(phone|tel|mobile|cell|call|fax|whatsapp|dial)\W{0,3}(\w+\W){0,2}$", re.IGNORECASE),
    "card_cue": re.compile(r"(card|visa|mastercard|amex|credit|debit|iban)\W{0,3}(\w+\W){0,2}$", re.IGNORECASE),
    "ip_cue": re.compile(r"(ip|host|server|address|addr|ping)\W{0,3}(\w+\W){0,2}$", re.IGNORECASE),
}


def segment_features(text: str, start: int, end: int) -> np.ndarray:
    """SHAPES of one whole segment of a text."""
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    runs = re.findall(r"[0-9]+", s)
    letters = sum(c.isalpha() for c in s)
    at_split = AT.split(s, maxsplit=1)
    host = DOT.sub(".", at_split[1]) if len(at_split) == 2 else ""
    local = DOT.sub(".", at_split[0]).strip()
    mail = len(at_split) == 2 and LOCAL.fullmatch(local) is not None and HOST.fullmatch(host) is not None
    bare = mail and host == at_split[1] and BARE_AT.search(s) is not None
    undotted = re.sub(r"\s*(?:[\[({<]\s*(?:dot|\.)\s*[\])}>]|\s+dot\s+)\s*", ".", s, flags=re.IGNORECASE)
    four = re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", undotted) is not None
    n = len(digits)
    before, after = text[start - 1 : start], text[end : end + 1]
    prior = text[max(0, start - 40) : start]
    groups = [len(r) for r in runs]
    number = not letters and n > 0
    f = {
        "bias": 1.0,
        "mail_shape": mail and s == at_split[0] + "@" + at_split[1] and " " not in s,
        "mail_disguised": mail and not (s == at_split[0] + "@" + at_split[1] and " " not in s),
        "dirty_ends": not (s[0].isalnum() or s[0] in "+(") or not s[-1].isalnum(),
        "four_parts": four, "octets": four and octets(undotted), "disguised_parts": four and undotted != s,
        "digits_7": number and n < 8, "digits_8_15": number and 8 <= n <= 15, "digits_16_19": number and 16 <= n <= 19,
        "luhn": number and 16 <= n <= 19 and luhn(digits),
        "plus": number and (s[0] == "+" or (s[:2] == "00" and len(runs) > 1)),
        "grouped": number and 3 <= len(runs) <= 5 and all(2 <= g <= 4 for g in groups[1:]) and groups[-1] >= 3,
        "card_groups": number and len(runs) >= 4 and all(g == 4 for g in groups[:-1]),
        "brackets": number and re.search(r"\([0-9]{2,4}\)", s) is not None,
        "other_letters": letters > 0 and not mail and undotted == s,
        "glued": before.isalnum() or after.isalnum() or (before != "" and before in "._-/@#$%€£:=" and before != ":" ) or (after != "" and after in "/@_%$€£"),
        "one_run": number and len(runs) == 1,
        "long_part": any(g > 4 for g in groups) and len(groups) > 1,
        "odd_separator": number and re.search(r"[^0-9+(). /-]", s) is not None,
        "doubled_separator": number and re.search(r"[^0-9()]{2,}", s.replace(") ", ")").replace(" (", "(")) is not None,
        "mail_goes_on": mail and MAIL_ON.match(text, end) is not None,
        "number_goes_on": number and (NUMBER_ON.match(text, end) is not None or NUMBER_FROM.search(text[max(0, start - 4) : start]) is not None),
        "bare_at": bare and host.rsplit(".", 1)[-1] not in COMMON_ENDINGS,
        "local_dots": mail and local != at_split[0].strip(),
        **{k: bool(cue.search(prior)) for k, cue in CUES.items()},
    }
    return np.array([float(f[k]) for k in SHAPES])


PLACE = {k: i for i, k in enumerate(SHAPES)}
NOT_OF_NUMBERS = re.compile(r"[^0-9+(). /-]")
BRACKETED = re.compile(r"\([0-9]{2,4}\)")
DOUBLED = re.compile(r"[^0-9()]{2,}")
PLAIN_FOUR = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
MARKED_DOT = re.compile(r"[\[({<]\s*\.\s*[\])}>]")
RUN = re.compile(r"[0-9]+")


def number_features(text: str, start: int, end: int, cues: list[bool], from_number: bool) -> np.ndarray | None:
    """``segment_features`` of a segment of digits and their signs; what only depends on its start is given.

    None where the segment has other letters or bracketed dots, which the general way deals with.
    """
    s = text[start:end]
    if not NUMBER_SIGNS.issuperset(s) or MARKED_DOT.search(s):
        return None
    out = np.zeros(len(SHAPES))
    runs = RUN.findall(s)
    n, last = sum(map(len, runs)), len(runs) - 1
    four = len(runs) == 4 and PLAIN_FOUR.fullmatch(s) is not None
    before, after = text[start - 1 : start], text[end : end + 1]
    out[PLACE["bias"]] = 1.0
    out[PLACE["dirty_ends"]] = not (s[0].isalnum() or s[0] in "+(") or not s[-1].isalnum()
    if four:
        out[PLACE["four_parts"]], out[PLACE["octets"]] = 1.0, octets(s)
    if n < 8:
        out[PLACE["digits_7"]] = 1.0
    elif n <= 15:
        out[PLACE["digits_8_15"]] = 1.0
    elif 16 <= n <= 19:
        out[PLACE["digits_16_19"]], out[PLACE["luhn"]] = 1.0, luhn("".join(runs))
    out[PLACE["plus"]] = s[0] == "+" or (s[:2] == "00" and last > 0)
    out[PLACE["grouped"]] = 2 <= last <= 4 and all(2 <= len(r) <= 4 for r in runs[1:]) and len(runs[-1]) >= 3
    out[PLACE["card_groups"]] = last >= 3 and all(len(r) == 4 for r in runs[:-1])
    out[PLACE["brackets"]] = "(" in s and BRACKETED.search(s) is not None
    out[PLACE["glued"]] = bool(before.isalnum() or after.isalnum() or before and before in "._-/@#$%€£=" or after and after in "/@_%$€£")
    out[PLACE["one_run"]] = last == 0
    out[PLACE["long_part"]] = last > 0 and any(len(r) > 4 for r in runs)
    out[PLACE["odd_separator"]] = NOT_OF_NUMBERS.search(s) is not None
    out[PLACE["doubled_separator"]] = DOUBLED.search(s.replace(") ", ")").replace(" (", "(")) is not None
    out[PLACE["number_goes_on"]] = from_number or NUMBER_ON.match(text, end) is not None
    for k, hit in zip(CUES, cues):
        out[PLACE[k]] = hit
    return out


def start_facts(text: str, start: int) -> tuple[list[bool], bool]:
    """What the text before a number says, the same for every end."""
    prior = text[max(0, start - 40) : start]
    return [bool(cue.search(prior)) for cue in CUES.values()], NUMBER_FROM.search(text[max(0, start - 4) : start]) is not None


def stretches(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Parts of the text, between the spans already taken, in which a segment may be: around each trigger."""
    edges, out = [0], []
    for start, end in sorted((s, e) for _, s, e in taken):
        edges += [start, end]
    edges.append(len(text))
    free = [(edges[i], edges[i + 1]) for i in range(0, len(edges) - 1, 2) if edges[i] < edges[i + 1]]
    for low, high in free:
        last = -1
        for m in TRIGGER.finditer(text, low, high):
            if m.start() < last:
                continue
            left, right = max(low, m.start() - 8 * MARGIN), min(high, m.end() + 8 * MARGIN)
            # Whole tokens only.
            while left > low and text[left - 1].isalnum() and text[left].isalnum():
                left -= 1
            while right < high and text[right - 1].isalnum() and text[right].isalnum():
                right += 1
            if out and left <= out[-1][1] and out[-1][0] >= low:
                out[-1] = (out[-1][0], right)
            else:
                out.append((left, right))
            last = right - 4 * MARGIN
    return out


def candidates(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], np.ndarray]:
    """Tokens of a stretch, candidate segments as (first, past-the-last) token, and their features."""
    tokens = [m.span() for m in TOKEN.finditer(text, start, end)]
    pieces = [text[a:b] for a, b in tokens]
    at_word = [p == "@" or p == "＠" or p.lower() == "at" for p in pieces]
    digit = [any("0" <= c <= "9" for c in p) for p in pieces]
    marks, rows = [], []
    for i, p in enumerate(pieces):
        starts_number = (digit[i] and p.isdigit()) or (p in "+(" and i + 1 < len(pieces) and digit[i + 1])
        starts_mail = p[0].isalnum() and any(at_word[i + 1 : i + 8]) and (i == 0 or pieces[i - 1] not in (".", "_", "-", "+", "%"))
        if starts_number:
            # A number: digits and their separators only, ending in digits.  No kind has more than 19 digits, and with
            # fewer than 7 only addresses of four parts are left.
            n, dots = 0, 0
            for j in range(i, min(i + LONGEST, len(pieces))):
                q = pieces[j]
                if not (q.isdigit() or len(q) == 1 and q in "+().-/·_ [{]}" or q.lower() == "dot"):
                    break
                n += len(q) if q.isdigit() else 0
                dots += q == "." or q.lower() == "dot"
                if n > 19:
                    break
                if q.isdigit() and (n >= 7 or n >= 4 and dots >= 3):
                    marks.append((i, j + 1))
        if starts_mail:
            seen = False
            for j in range(i, min(i + LONGEST, len(pieces))):
                q = pieces[j]
                if not (q[0].isalnum() or q.isspace() and "\n" not in q or q in "._%+-@＠[](){}<>"):
                    break
                seen = seen or at_word[j]
                if seen and q[0].isalnum() and not at_word[j] and len(q) >= 2:
                    marks.append((i, j + 1))
    facts: dict[int, tuple[list[bool], bool]] = {}
    for i, j in marks:
        a, b = tokens[i][0], tokens[j - 1][1]
        if digit[i] or pieces[i] in "+(":
            if a not in facts:
                facts[a] = start_facts(text, a)
            quick = number_features(text, a, b, *facts[a])
        else:
            quick = None
        rows.append(segment_features(text, a, b) if quick is None else quick)
    return tokens, marks, np.array(rows).reshape(-1, len(SHAPES))


def best_segments(size: int, marks: list[tuple[int, int]], scores: np.ndarray) -> list[tuple[int, int]]:
    """(candidate, kind) of the best segmentation: plain tokens score 0, segments their score; bounded segments, one pass."""
    ending: dict[int, list[int]] = {}
    for c, (_, j) in enumerate(marks):
        ending.setdefault(j, []).append(c)
    best, back = [0.0] * (size + 1), [None] * (size + 1)
    for j in range(1, size + 1):
        best[j], back[j] = best[j - 1], None
        for c in ending.get(j, ()):
            kind = int(scores[c].argmax())
            total = best[marks[c][0]] + scores[c, kind]
            if total > best[j]:
                best[j], back[j] = total, (c, kind)
    out, j = [], size
    while j:
        if back[j] is None:
            j -= 1
        else:
            out.append(back[j])
            j = marks[back[j][0]][0]
    return out[::-1]


def expected(size: int, marks: list[tuple[int, int]], scores: np.ndarray) -> tuple[float, np.ndarray]:
    """Log of the sum over all segmentations, and the probability of each (candidate, kind): forward and backward."""
    forward, backward = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
    forward[0] = backward[size] = 0.0
    mass = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
    ending: dict[int, list[int]] = {}
    starting: dict[int, list[int]] = {}
    for c, (i, j) in enumerate(marks):
        ending.setdefault(j, []).append(c)
        starting.setdefault(i, []).append(c)
    for j in range(1, size + 1):
        forward[j] = np.logaddexp.reduce([forward[j - 1], *[forward[marks[c][0]] + mass[c] for c in ending.get(j, ())]])
    for i in range(size - 1, -1, -1):
        backward[i] = np.logaddexp.reduce([backward[i + 1], *[mass[c] + backward[marks[c][1]] for c in starting.get(i, ())]])
    logs = np.array([forward[i] + backward[j] for i, j in marks])[:, None] + scores - forward[size] if marks else scores
    return float(forward[size]), np.exp(logs)


FILLER = (
    "the of and to a in is it on with from was as by for that this report meeting order page chapter section total value "
    "item week model version group der die und mit eine les des pour dans una los para con"
).split()


def example(pick: random.Random) -> tuple[str, list[Span]]:
    """Generated text with its spans: regular and disguised ones, and look-alikes that are none."""
    text, spans = "", []
    number = lambda n: "".join(pick.choice("0123456789") for _ in range(n))
    name = lambda: "".join(pick.choice("abcdefghijklmnoprstuvw") for _ in range(pick.randint(3, 9)))

    def card() -> str:
        head = number(15)
        return next(head + c for c in "0123456789" if luhn(head + c))

    def cut(digits: str, by: str) -> str:
        return by.join(digits[i : i + 4] for i in range(0, len(digits), 4))

    for _ in range(pick.randint(2, 5)):
        if not text or pick.random() < 0.75:
            text += " ".join(pick.choices(FILLER, k=pick.randint(2, 7))) + " "
        what, kind = pick.random(), None
        if what < 0.14:
            kind, host = "email", f"{name()}.{pick.choice(['com', 'org', 'example.net'])}"
            at, dot = pick.choice([("@", "."), (" at ", " dot "), ("[at]", "[dot]"), (" [at] ", "."), ("(at)", "."), (" @ ", "."), (" at ", "."), (" (at) ", " (dot) ")])
            s = f"{name()}{pick.choice(['', '.' + name(), number(2), *([dot + name()] if dot != '.' else [])])}{at}{host.replace('.', dot)}"
        elif what < 0.26:
            kind, s = "ip", pick.choice([".", ".", "[.]", "(.)", " dot "]).join(str(pick.randint(0, 255)) for _ in range(4))
        elif what < 0.40:
            kind = "card"
            s = pick.choice([lambda: card(), lambda: cut(card(), "."), lambda: cut(card(), " "), lambda: cut(card(), "-"), lambda: cut(card(), "/"), lambda: cut(card(), "_")])()
        elif what < 0.56:
            kind, sep = "phone", pick.choice([" ", "-", ".", " "])
            body = sep.join([number(3), number(3), number(4)])
            s = pick.choice([f"+{pick.randint(1, 99)}{sep}{body}", f"({body[:3]}) {body[4:]}", f"+{pick.randint(1, 99)} ({body[:3]}) {body[4:]}", f"00{pick.randint(1, 99)}{sep}{body}"])
            if pick.random() < 0.3:
                text, s = text + pick.choice(["phone ", "call ", "tel: "]), body
        else:
            s = pick.choice([
                lambda: f"{pick.randint(0, 30)}.{pick.randint(0, 20)}", lambda: f"{pick.randint(1, 9)}.{pick.randint(0, 9)}.{pick.randint(0, 99)}",
                lambda: f"20{number(2)}-{pick.randint(10, 12)}-{pick.randint(10, 28)}", lambda: f"{pick.randint(10, 28)}/{pick.randint(10, 12)}/20{number(2)}",
                lambda: f"${number(3)},{number(3)}.{number(2)}", lambda: number(pick.randint(1, 12)), lambda: number(16) if pick.random() < 0.5 else number(20),
                lambda: "".join(pick.choice("0123456789abcdef") for _ in range(40)), lambda: f"at {name()} dot", lambda: f"{number(4)} {number(4)}",
                lambda: f"{pick.randint(300, 999)}.{pick.randint(300, 999)}.{number(3)}.{number(3)}", lambda: f"{number(2)}:{number(2)}:{number(2)}",
                lambda: f"{number(3)}-{number(5)}", lambda: f"{number(5)} {number(2)} {number(6)}", lambda: f"@{name()}", lambda: f"{number(3)} {number(3)} {number(4)}",
                lambda: f"{name()}-{number(3)}-{number(3)}-{number(4)}", lambda: f"{number(4)}-{number(4)}-{number(4)}-{number(4)}", lambda: f"looked at {name()}.", lambda: f"{name()} at {name()}. {name()}", lambda: f"{name()} at {name()}.{name().title()}",
                lambda: f"{name()} at {name()}.{pick.choice(['html', 'then', 'pdf', 'txt', 'php', 'we', 'jpg'])} ",
                lambda: ", ".join(number(3) for _ in range(4)), lambda: f"{number(4)}.{number(4)}.{number(4)}.{number(4)}",
            ])()
            if re.fullmatch(r"\d{16}|(\d{4}[-.]){3}\d{4}", s) and luhn(re.sub(r"\D", "", s)):
                kind = "card"
        if kind:
            spans.append((kind, len(text), len(text) + len(s)))
        text += s + pick.choice([" ", ", ", ". ", "\n"])
    return text, spans


@functools.cache
def trained(seed: int = 11, texts: int = 400, rounds: int = 120) -> np.ndarray:
    """Weights (kinds x shapes): the penalised likelihood of the generated segmentations, by gradient steps."""
    pick, data = random.Random(seed), []
    for _ in range(texts):
        text, spans = example(pick)
        places = {(a, b): KINDS.index(k) for k, a, b in spans}
        for start, end in stretches(text, []):
            tokens, marks, x = candidates(text, start, end)
            truth = np.zeros((len(marks), len(KINDS)))
            for c, (i, j) in enumerate(marks):
                kind = places.get((tokens[i][0], tokens[j - 1][1]))
                if kind is not None:
                    truth[c, kind] = 1.0
            if marks:
                data.append((len(tokens), marks, x, truth))
    w, m, v = np.zeros((len(KINDS), len(SHAPES))), 0.0, 0.0
    for step in range(1, rounds + 1):
        grad = -0.02 * w
        for size, marks, x, truth in data[step % 5 :: 5]:
            _, p = expected(size, marks, x @ w.T)
            grad += (truth - p).T @ x * (5 / len(data) * 20)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def added_spans(text: str, taken: list[Span], weights: np.ndarray, least: float) -> list[Span]:
    """Segments of the best segmentation outside ``taken`` that score at least ``least`` above plain text."""
    out = []
    for start, end in stretches(text, taken):
        tokens, marks, x = candidates(text, start, end)
        if not marks:
            continue
        scores = x @ weights.T
        for c, kind in best_segments(len(tokens), marks, scores):
            if scores[c, kind] >= least:
                out.append((KINDS[kind], tokens[marks[c][0]][0], tokens[marks[c][1] - 1][1]))
    return out


def listed(spans: list[Span]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


#: What a span of the field must score above plain text: odds of about 4 to 1.
LEAST_SCORE = 1.5
SPAN = "kind string, start long, end long"


def find_spans(docs: DataFrame, ident: str = "doc_id", least: float = LEAST_SCORE, column: str = "text") -> DataFrame:
    """(ident, base, added): arrays of (kind, start, end) in code points, end exclusive, by kind then start.

    Base spans follow the fixed patterns; added ones are the field's and never overlap them.  Spans of different
    kinds may overlap among the base ones.  Null and empty texts have none.  Repeated rows and idents keep a row
    each; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    order = {k: i for i, k in enumerate(KINDS)}

    def make():
        def find(text: str) -> tuple[list[dict], list[dict]]:
            base = base_spans(text)
            added = added_spans(text, base, shared.value, least)
            rows = [sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])) for spans in (base, added)]
            return tuple([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans] for spans in rows)

        return find

    return per_row(docs, [clear_text(column)], make, "base array<struct<kind:string,start:bigint,end:bigint>>, added array<struct<kind:string,start:bigint,end:bigint>>", [ident])


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are one, named by the first."""
    out, upto = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= upto:
            out += [text[upto:start], f"[{kind.upper()}]"]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def mask(docs: DataFrame, least: float = LEAST_SCORE, column: str = "text") -> DataFrame:
    """``docs`` with personal data in ``column`` replaced by [EMAIL], [IP], [CARD] or [PHONE]; null texts stay null, other columns are unchanged.

    Rows are masked one by one: repeated rows stay repeated, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def make():
        def work(text: str | None) -> tuple[str | None]:
            if not text:
                return (text,)
            base = base_spans(text)
            return (masked(text, base + added_spans(text, base, shared.value, least)),)

        return work

    others = [c for c in docs.columns if c != column]
    done = per_row(docs, [F.col(column)], make, f"`{column}` string", others)
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(base: list[Span]) -> str:
    return hashlib.sha256(listed(base).encode()).hexdigest()
