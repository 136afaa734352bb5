"""Personal data: base patterns, and a linear-chain conditional random field for forms they miss.

The field labels tokens as outside, beginning or inside an e-mail address, IP address, card or phone
number. Its features are shapes of the token and of two neighbours on either side, and what chain of
digits the token stands in; it never sees a word that is not on a short list of roles. It is trained
in numpy on a small labelled table, EXAMPLES, and decoded by Viterbi over batches of windows around
digits, at signs and words that stand for one.
"""

from __future__ import annotations

import random
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meltemi.llm.common import BATCH_BYTES

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
OUTPUT = [*(f"n_{k}" for k in KINDS), "base", "spans", "redacted_text"]
STATES = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
#: Characters read on either side of a digit or at sign, and how much further to the next white space.
REACH, STRETCH = 48, 24
#: Tokens decoded together, padding included; one longer window is decoded alone.
DECODE = 1 << 17

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive, so that a chain of any length needs no memory to go back in.
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The run before each at sign is measured from the last one, so a long run is read once."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = max(free, at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Fours of a chain of dotted numbers, from the left; a number's digits are never parted."""
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".") if "." in chain.group() else ()
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k:k + 4]
            size = sum(map(len, own)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in own):
                yield at, at + size
            at += size + 1


def _counted(pattern: re.Pattern, low: int, high: int, text: str, check=None) -> Iterator[tuple[int, int]]:
    for m in pattern.finditer(text):
        own = m.group()
        if len(own) <= 4 * high or sum(map(str.isdigit, own)) <= high:
            digits = "".join(_DIGITS.findall(own))
            if low <= len(digits) <= high and (check is None or check(digits)):
                yield m.span()


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of what the plain patterns find, by start and then kind as listed."""
    found = [(s, "email", e) for s, e in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        found += [(s, "ip", e) for s, e in _ips(text)]
        found += [(s, "card", e) for s, e in _counted(_CARD, 12, 19, text, luhn)]
        if "+" in text:
            found += [(s, "phone", e) for s, e in _counted(_PHONE, 9, 15, text)]
    return sorted(found, key=_order)


def _order(span: tuple[int, str, int]) -> tuple:
    return span[0], KINDS.index(span[1]), span[2]


# ---- features -----------------------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_CHAIN = re.compile(r"[0-9]++(?:[ .()/-]{1,2}[0-9]++)*+")
_MARKS = "@.-+()[]{}:/_,#'\"<>=%"
_ROLES = {
    word: role for role, words in {
        "at": "at arobase arroba", "dot": "dot", "tld": "com org net edu gov info io de fr es uk eu",
        "tel": "tel phone telephone mobile cell fax call telefon handy rufen téléphone portable teléfono móvil llame",
        "mail": "mail email write contact kontakt correo courriel", "net": "ip host server address adresse client dirección",
        "pay": "card visa mastercard credit karte carte tarjeta",
        "code": "order invoice token key isbn version id ref serial page rechnung commande pedido hash",
    }.items() for word in words.split()
}


def _digit_shape(d: str) -> str:
    n = len(d)
    if 12 <= n <= 19:
        return "card" if luhn(d) else "long"
    if n == 3:
        return "byte" if int(d) <= 255 else "3"
    return str(n) if n < 7 else "7-9" if n < 10 else "10-11" if n < 12 else "20"


def shape(token: str) -> str:
    if token[0] in "0123456789":
        return "0" + _digit_shape(token)
    if not token[0].isalpha():
        return token if token in _MARKS else "mark"
    role = _ROLES.get(token.lower())
    if role:
        return "=" + role
    if not token.isascii():
        return "u"
    case = "a" if token.islower() else "A" if token.isupper() else "Aa" if token[1:].islower() else "aA"
    return case + ("1" if len(token) == 1 else "3" if len(token) < 4 else "")


_SHAPES = [
    *(f"0{d}" for d in "1 2 byte 3 4 5 6 7-9 10-11 card long 20".split()), *_MARKS, "mark", *sorted({f"={r}" for r in _ROLES.values()}),
    "u", *(c + n for c in ("a", "A", "Aa", "aA") for n in ("", "1", "3")),
]
#: A shape has one number after white space and one without; zero stands beyond the ends.
_NUMBER = {s: 2 * k + 1 for k, s in enumerate(_SHAPES)}
CLASSES = 2 * len(_SHAPES) + 1
#: Kinds of digit chains: none, then length of all digits by how many groups they come in.
CHAINS = 1 + 9 * 5


def _chain_kind(own: str) -> int:
    groups = re.split(r"[^0-9]+", own)
    digits = sum(map(len, groups))
    if len(groups) == 4 and own.count(".") == 3 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        size = 8
    elif 12 <= digits <= 19:
        size = 6 if luhn("".join(groups)) else 5
    else:
        size = 0 if digits < 7 else 1 if digits < 9 else 2 if digits < 10 else 3 if digits < 12 else 7
    return 1 + 5 * size + min(len(groups), 5) - 1


def tokens_of(text: str) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Spans of the tokens, and per token the number of its shape and the kind of its digit chain."""
    spans, shapes, ends = [], [], 0
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        shapes.append(_NUMBER[shape(m.group())] + (s == ends and s > 0))
        spans.append((s, e))
        ends = e
    chains = np.zeros(len(spans), np.int64)
    starts = np.array([s for s, _ in spans], np.int64)
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() <= 80:
            lo, hi = np.searchsorted(starts, m.span())
            chains[lo:hi] = _chain_kind(m.group())
    return spans, np.array(shapes, np.int64), chains


# ---- the field ----------------------------------------------------------------------------------

@dataclass
class Crf:
    """Weights: shapes at offsets -2 to 2 by state, digit chains by state, steps between states."""

    shapes: np.ndarray
    chains: np.ndarray
    steps: np.ndarray

    def emissions(self, shapes: np.ndarray, chains: np.ndarray) -> np.ndarray:
        """(rows, tokens, states) of padded rows of shape numbers."""
        wide = np.pad(shapes, ((0, 0), (2, 2)))
        n = shapes.shape[1]
        return sum(self.shapes[k][wide[:, k:k + n]] for k in range(5)) + self.chains[chains]

    def decode(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Best states of each row by Viterbi, rows of like length together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)
        order = sorted((k for k in range(len(rows)) if len(rows[k][0])), key=lambda k: len(rows[k][0]))
        while order:
            part = [order.pop()]
            longest = len(rows[part[0]][0])
            while order and (len(part) + 1) * longest <= DECODE:
                part.append(order.pop())
            for k, best in zip(part, self._viterbi([rows[k] for k in part], longest)):
                out[k] = best
        return out

    def _viterbi(self, rows: list[tuple[np.ndarray, np.ndarray]], longest: int) -> Iterator[np.ndarray]:
        sizes = np.array([len(r[0]) for r in rows])
        own = self.emissions(*(np.stack([np.pad(r[c], (0, longest - len(r[c]))) for r in rows]) for c in (0, 1)))
        back = np.zeros((len(rows), longest, len(STATES)), np.int8)
        score = own[:, 0] + _FIRST
        for t in range(1, longest):
            ways = score[:, :, None] + self.steps
            back[:, t] = ways.argmax(axis=1)
            score = np.where((t < sizes)[:, None], ways.max(axis=1) + own[:, t], score)
        path = np.zeros((len(rows), longest), np.int64)
        state = score.argmax(axis=1)
        everyone = np.arange(len(rows))
        for t in range(longest - 1, -1, -1):
            inside = t < sizes
            path[inside, t] = state[inside]
            state = np.where(inside, back[everyone, t, state], state)
        return (p[:n] for p, n in zip(path, sizes))


#: An inside state follows its own beginning or itself, and never comes first.
_NEVER = -1e4
_FIRST = np.array([_NEVER if s[0] == "I" else 0.0 for s in STATES])
_BARRED = np.array([[_NEVER if b[0] == "I" and a[1:] != b[1:] else 0.0 for b in STATES] for a in STATES])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int = 80, rate: float = 0.1, decay: float = 2e-3) -> Crf:
    """Maximum likelihood over rows of (shapes, chains, states) by forward-backward and Adam steps on all rows at once."""
    longest = max(len(r[0]) for r in rows)
    shapes, chains, states = (np.stack([np.pad(r[c], (0, longest - len(r[c]))) for r in rows]) for c in range(3))
    sizes, k = np.array([len(r[0]) for r in rows]), len(STATES)
    inside = np.arange(longest) < sizes[:, None]
    wide = np.pad(np.where(inside, shapes, 0), ((0, 0), (2, 2)))
    truth = np.eye(k)[states] * inside[:, :, None]
    pairs = inside[:, 1:]
    true_steps = np.zeros((k, k))
    np.add.at(true_steps, (states[:, :-1][pairs], states[:, 1:][pairs]), 1)
    model = Crf(np.zeros((5, CLASSES, k)), np.zeros((CHAINS, k)), np.zeros((k, k)))
    weights = [model.shapes, model.chains, model.steps]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for turn in range(1, rounds + 1):
        own, steps = model.emissions(shapes, chains), model.steps + _BARRED
        ahead, behind = np.zeros_like(own), np.zeros_like(own)
        ahead[:, 0] = own[:, 0] + _FIRST
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + steps, 1) + own[:, t]
        for t in range(longest - 2, -1, -1):
            more = _log_sum(steps[None] + (own[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], more, 0)
        whole = _log_sum(ahead[np.arange(len(rows)), sizes - 1], 1)
        chance = np.exp(ahead + behind - whole[:, None, None]) * inside[:, :, None]
        wrong = truth - chance
        ways = ahead[:, :-1, :, None] + steps + (own[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        slopes = [np.zeros_like(w) for w in weights]
        for o in range(5):
            np.add.at(slopes[0][o], wide[:, o:o + longest].ravel(), wrong.reshape(-1, k))
        np.add.at(slopes[1], chains.ravel(), wrong.reshape(-1, k))
        slopes[2] = true_steps - np.exp(ways[pairs]).sum(axis=0)
        for w, slope, (first, second) in zip(weights, slopes, moments):
            slope = slope / len(rows) - decay * w
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            w += rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return Crf(model.shapes, model.chains, model.steps + _BARRED)


# ---- the labelled table -------------------------------------------------------------------------

#: Marked personal data, {kind:...}. W stands for a word, 9 for a digit, B for a number up to 255, C for a number
#: with a right check digit and X for one with a wrong one; each row is filled in several ways.
EXAMPLES = """
W W {email:W@W.com} W W
W W {email:W.99@W9.W.com} W. W
W {email:W at W dot com} W W
W, {email:W dot W at W dot org}, W
W W {email:W [at] W [dot] com} W
W {email:W(at)W(dot)de} W
W {email:W (at) W.net}. W W
W {email:W.W [at] W.com} W
W {email:W AT W DOT fr} W
mail: {email:W_W at W dot io}
W W {ip:B.B.B.B} W W
W {ip:B.B.B.B}, {ip:B.B.B.B} W
W {ip:B[.]B[.]B[.]B} W
host {ip:B . B . B . B} W
W {ip:B.B.B.B}:9999 W
W W {card:C} W W
W {card:C} {card:C} W
W {card:C} X W
W X {card:C} W
{card:C} {card:C} {card:C} W
W {card:C} {phone:+9 (999) 999-9999} W
W W {phone:+9 (999) 999-9999} W W
W {phone:+9 (999) 999-9999} {card:C} W
W {phone:+9 (999) 999-9999} {ip:B.B.B.B} W
W {phone:+9 (999) 999-9999} {phone:+9 (999) 999-9999} W
W {phone:+9 (999) 999-9999} 99999999999999 W
W {phone:+9 (999) 999-9999} X W
{ip:B.B.B.B} {card:C} W
{card:C} {ip:B.B.B.B} W
W W {phone:(999) 999-9999} W W
W {phone:999-999-9999}, W
tel {phone:999 999 9999} W
tel. {phone:99 99 99 99 99} W W
phone: {phone:099/9999999} W
call {phone:999.999.9999} W
fax: {phone:999-9999} W
W W {phone:+99 999 9999999} W
W {phone:+99-99-99999999}. W
W W {email:W at W dot com}, W {phone:(999) 999-9999} W
W {card:C} W W at W W
W W W W. W W, W W W.
W W X W W W
W W X X W
X X W X W
W 99999999999999 W W
W 999999 W 99999999 W
W 9.9. W 9. W
W 9.9.9 W W
version 9.99.9 W W
W 99.99 W, 9,999.99 W
W (99) W [9] W {99} W
W 9999-99-99 W 99:99 W
99/99/9999 W W
W 99-99 W 999-999 W
W W = "9W9W99W9999W9W9" W
W = "99W9W9W999W9WW9" W W
token = "W9W99W9W9W" W
W W9 W99 W9W W
order 999-9999999-9999999 W
isbn 999-9-99-999999-9 W
W at W, W at W W
W dot W W. W
W at W, at W dot. W
W 99 at 99 W W
page 99 W 99 W
W W 9 W 99 W 999 W 9999
W, 99% W $99 W
W@W W @W W
W *** W99 ### W &&&
W at 99:99 W
W # 99999 W id 9999999999
""".strip().splitlines()

_SLOT = re.compile(r"W|X|C|B|9")


def _word(rng: random.Random) -> str:
    letters = rng.choice(["abcdefghijklmnoprstuvw"] * 5 + ["abcdeéèßüñóíç", "дежзиклмн"])
    word = "".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 7, 8, 10))))
    return rng.choice([word] * 6 + [word.capitalize(), word.capitalize(), word.upper()])


def _card_digits(rng: random.Random, right: bool) -> str:
    own = "".join(rng.choice("0123456789") for _ in range(rng.choice((14, 15, 15, 15))))
    return next(own + d for d in rng.sample("0123456789", 10) if luhn(own + d) == right)


def _filled(template: str, rng: random.Random) -> str:
    fill = {"W": _word, "9": lambda r: r.choice("0123456789"), "B": lambda r: str(r.randrange(256)),
            "C": lambda r: _card_digits(r, True), "X": lambda r: _card_digits(r, False)}
    return _SLOT.sub(lambda m: fill[m.group()](rng), template)


def labelled_rows(examples: list[str], copies: int, seed: int) -> list[tuple[str, list[tuple[int, str, int]]]]:
    """(text, spans) of the labelled table, each row filled `copies` times, every other time with another row behind it."""
    rng, out = random.Random(seed), []
    for k, row in enumerate(examples * copies):
        row = f"{row} {rng.choice(examples)}" if k // len(examples) % 2 else row
        text, spans = "", []
        for part in re.split(r"(\{[a-z]+:[^{}]*\})", row):
            marked = re.fullmatch(r"\{([a-z]+):(.*)\}", part)
            own = _filled(marked[2] if marked else part, rng)
            if marked:
                spans.append((len(text), marked[1], len(text) + len(own)))
            text += own
        out.append((text, spans))
    return out


def _states(tokens: list[tuple[int, int]], spans: list[tuple[int, str, int]]) -> np.ndarray:
    states = np.zeros(len(tokens), np.int64)
    for start, kind, end in spans:
        own = [k for k, (s, e) in enumerate(tokens) if s >= start and e <= end]
        states[own] = STATES.index(f"I-{kind}")
        states[own[:1]] = STATES.index(f"B-{kind}")
    return states


def fit(examples: list[str] | None = None, copies: int = 6, seed: int = 3) -> Crf:
    """Train on the labelled table, a few hundred short rows on the driver."""
    rows = []
    for text, spans in labelled_rows(EXAMPLES if examples is None else examples, copies, seed):
        tokens, shapes, chains = tokens_of(text)
        rows.append((shapes, chains, _states(tokens, spans)))
    return train(rows)


# ---- search -------------------------------------------------------------------------------------

_SIGNS = re.compile(r"[0-9@(\[{][0-9]*")
_BRACKETED = re.compile(r"[(\[{] ?(?:at|dot) ?[)\]}]", re.IGNORECASE)
_SPELT = re.compile(r"\bdot\b", re.IGNORECASE)


def windows_of(text: str) -> list[tuple[int, int]]:
    """Disjoint parts of a text around digits, at signs and words that stand for one."""
    at = [m.span() for m in _SIGNS.finditer(text) if m.group()[0] not in "([{" or m.end() > m.start() + 1 or _BRACKETED.match(text, m.start())]
    if "dot" in text or "DOT" in text or "Dot" in text:
        at = sorted(at + [m.span() for m in _SPELT.finditer(text)])
    out: list[list[int]] = []
    for s, e in at:
        lo, hi = max(0, s - REACH), min(len(text), e + REACH)
        if out and lo <= out[-1][1] + 2 * STRETCH:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    for w in out:
        lo, hi = w
        if lo > 0:
            before = max(text.rfind(" ", max(0, lo - STRETCH), lo), text.rfind("\n", max(0, lo - STRETCH), lo))
            w[0] = before + 1 if before >= 0 else lo
        ends = [x for x in (text.find(" ", hi, hi + STRETCH), text.find("\n", hi, hi + STRETCH)) if x >= 0]
        w[1] = min(ends) if ends else hi
    return [(lo, hi) for lo, hi in out]


def plausible(kind: str, own: str) -> bool:
    """What any datum of a kind must have, whatever its form."""
    digits = "".join(_DIGITS.findall(own)) if len(own) <= 80 else ""
    if kind == "email":
        return bool(re.search(r"@|\bat\b|arobase|arroba", own, re.IGNORECASE)) and bool(re.search(r"(\.|\bdot\b)\W{0,3}\w+$", own, re.IGNORECASE))
    if kind == "ip":
        parts = re.findall("[0-9]+", own) if len(own) <= 40 else []
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 7 <= len(digits) <= 15


def added_spans(texts: list[str], model: Crf) -> list[list[tuple[int, str, int]]]:
    """(start, kind, end) of what the field finds in each text."""
    places, rows, tokens = [], [], []
    for k, text in enumerate(texts):
        for lo, hi in windows_of(text):
            own, shapes, chains = tokens_of(text[lo:hi])
            places.append((k, lo))
            tokens.append(own)
            rows.append((shapes, chains))
    out: list[list[tuple[int, str, int]]] = [[] for _ in texts]
    for (k, lo), own, states in zip(places, tokens, model.decode(rows)):
        open_ = None
        for (s, e), state in zip([*own, (0, 0)], [*states.tolist(), 0]):
            name = STATES[state]
            if open_ and name[0] != "I":
                start, kind, end = open_
                if plausible(kind, texts[k][start:end]):
                    out[k].append(open_)
                open_ = None
            if name[0] == "B":
                open_ = (lo + s, name[2:], lo + e)
            elif name[0] == "I":
                open_ = (open_[0], open_[1], lo + e)
    return out


def all_spans(base: list[tuple[int, str, int]], added: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Base spans stay; of the others those that touch none of them."""
    taken = sorted((s, e) for s, _, e in base)
    ends = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, np.int64)
    starts = np.array([s for s, _ in taken], np.int64)
    free = []
    for span in added:
        before = int(np.searchsorted(starts, span[2], "left"))
        if not before or ends[before - 1] <= span[0]:
            free.append(span)
    return sorted([*base, *free], key=_order)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    out, at = [], 0
    for s, kind, e in spans:
        if e > at:
            out += [text[at:max(at, s)], f"[{kind.upper()}]" if s >= at else ""]
            at = e
    return "".join([*out, text[at:]])


def _written(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, kind, e in spans)


def _find_batches(model: Crf, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [t or "" for t in batch.column(0).to_pylist()]
            base = [base_spans(t) for t in own]
            spans = [all_spans(b, a) for b, a in zip(base, added_spans(own, model))]
            counts = [pa.array([sum(s[1] == kind for s in b) for b in base], pa.int64()) for kind in KINDS]
            strings = [list(map(_written, base)), list(map(_written, spans))]
            if texts:
                strings.append([redacted(t, s) for t, s in zip(own, spans)])
            columns = [*batch.columns[1:], *counts, *(pa.array(s, pa.string()) for s in strings)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], *OUTPUT[:len(counts) + len(strings)]])

    return run


def find(docs: DataFrame, model: Crf, text: str = "text", texts: bool = True) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (spans of the base patterns), base and spans (kind:start:end in code
    points, by start and then kind, comma-joined) and, with texts, redacted_text.

    spans holds the base spans and those of the field that touch none of them. A null or empty text has
    none, and an empty redacted text. Rows are judged alone, so repeats get equal results. Columns named
    like an output are replaced, all others kept; an empty table stays empty. A text of any length is
    read whole; only windows around digits and at signs are labelled.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    outputs = OUTPUT if texts else OUTPUT[:-1]
    kept = [c for c in docs.columns if c not in outputs]
    own = "text"
    while own in docs.columns:
        own += "_"
    frame = docs.select(F.col(f"`{text}`").alias(own), *[F.col(f"`{c}`") for c in kept])
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[1:]),
                       *(f"{c} long" for c in OUTPUT[:4]), *(f"{c} string" for c in outputs[4:])])
    return frame.mapInArrow(_find_batches(model, texts), kinds)
