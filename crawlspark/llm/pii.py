"""Personal data: fixed patterns, and a linear-chain CRF over word shapes that adds to them.

Base kinds (`email`, `ip`, `card`, `phone`) follow fixed patterns. The CRF labels words
O, EMAIL, IP, CARD or PHONE from features of their shape only; it is trained from the
small labelled table below. Words without a digit, `@` or `+` can only be O, in training
as in decoding, so the best path of a text falls apart at such words into short
chains, which are decoded by Viterbi in numpy batches of equal length. A chain may be
of any length.

Null texts count as empty. Repeated rows and ties in doc_id give one row each; columns
other than doc_id and text are ignored; an empty table gives an empty result. Spans are
in code points, end exclusive. Added spans never overlap a base span.
"""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, bound_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)

# The patterns of the base kinds. Each is applied in a form that takes linear time.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_OPEN = np.zeros(256, bool)
_OPEN[list(b"0123456789@+")] = True

# The labelled table: a line per example, `word/LABEL` or `word` for O. Made up; no real data.
EXAMPLES = """
call (743)/phone 555-3824/phone now
phone: 743-555-3824/phone today
tel 743.555.3824/phone ext 12
ring (212)/phone 555-0147/phone or (212)/phone 555-0199/phone please
fax 0044/phone 20/phone 7946/phone 0958/phone
dial +1/phone (523)/phone 555-1055/phone soon
or +44/phone 20/phone 7946/phone 0958/phone then
at +49-30-555-0123/phone we
mail jane.doe@example.com/email for it
write to x_1@mail.example.org/email today
or bob+tag@example.co.uk/email then
host 10.0.0.7/ip is up
from 192.168.1.20:8080/ip to 172.16.0.1/ip
pay 4539578763621486/card now
card 4539/card 5787/card 6362/card 1486/card ok
or 4539-5787-6362-1486/card ok
in 1999 and 2024
the 3 of 12 were 45
version 1.2.3 of 2.0
on 2024-01-31 at 10:45
for $1,250.00 and 99%
pages 100-120 of 350
no. 12345 and id 1234567
sum 1234567890123 or 98765432101234567890
code 9f86d081884c7d65 and 0x1f
ratio 3.14159 to 2.71828
items 1 2 3 4 5 6
room 12a on 4th
by @handle and 5+3
a+b or c++ and 7@
at 12:30:45 on 31.12.1999
token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff end
size 1024x768 or 10.5.2
section 4.3.2.1a and 12.5.1.
"""


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind."""
    spans, end = [], 0
    if "@" in text:
        for match in EMAIL_DOMAIN.finditer(text):
            start = match.start()
            while start > end and text[start - 1] in EMAIL_LOCAL:
                start -= 1
            if start < match.start():
                spans.append((start, match.end(), "email"))
                end = match.end()
    for match in DOTTED.finditer(text):
        if match[0].count(".") < 3:
            continue
        parts, start = match[0].split("."), match.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first:first + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in four):
                spans.append((start, stop, "ip"))
            start = stop + 1
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((match.start(), match.end(), "card"))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, match[0])) <= 15:
                spans.append((match.start(), match.end(), "phone"))
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def shape(word: str) -> str:
    """Digits become 0, letters a, runs of either their length up to 9; other characters stay."""
    word = word.strip(".,;:!?\"'#$%&*[]{}<>|")
    word = re.sub(r"[A-Za-z]+", lambda m: "a" if len(m[0]) < 9 else "b", word)
    return re.sub(r"[0-9]+", lambda m: "0" * min(len(m[0]), 20), word)[:40]


def features(word: str) -> list[str]:
    form = shape(word)
    digits = form.count("0")
    kinds = "".join(sorted(set(form)))
    return ["all", f"form={form}", f"digits={min(digits, 20)}", f"kinds={kinds}", f"groups={len(re.findall('0+', form))}",
            f"at={'@' in form and '.' in form.split('@')[-1] and not form.startswith('@')}",
            f"dots={form.count('.')}/{len(re.findall('0+', form))}", f"paren={form[:1] == '('}{form[-1:] == ')'}",
            f"plus={form[:1] == '+'}", f"letters={'a' in form or 'b' in form}"]


class Crf:
    """Weights of a trained chain: features to labels, and label to label."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    def scores(self, word: str) -> np.ndarray:
        known = [self.index[name] for name in features(word) if name in self.index]
        return self.emit[known].sum(axis=0)

    def decode(self, chains: list[list[str]]) -> list[np.ndarray]:
        """Labels of each chain. Chains of one length are decoded together."""
        cache: dict[str, np.ndarray] = {}
        by_length = defaultdict(list)
        for place, chain in enumerate(chains):
            by_length[len(chain)].append(place)
        found: list = [None] * len(chains)
        for length, places in by_length.items():
            emit = np.empty((len(places), length, len(LABELS)), np.float32)
            for row, place in enumerate(places):
                for step, word in enumerate(chains[place]):
                    if (score := cache.get(word)) is None:
                        score = cache[word] = self.scores(word)
                    emit[row, step] = score
            best, back = emit[:, 0], np.zeros((len(places), length, len(LABELS)), np.int8)
            for step in range(1, length):
                ways = best[:, :, None] + self.move
                back[:, step] = ways.argmax(axis=1)
                best = ways.max(axis=1) + emit[:, step]
            path = np.zeros((len(places), length), np.int8)
            path[:, -1] = best.argmax(axis=1)
            for step in range(length - 1, 0, -1):
                path[:, step - 1] = back[np.arange(len(places)), step, path[:, step]]
            for row, place in enumerate(places):
                found[place] = path[row]
        return found


def examples(table: str = EXAMPLES) -> list[list[tuple[str, int]]]:
    """Chains of (word, label): neighbouring open words of each line."""
    chains = []
    for line in table.strip().splitlines():
        chain = []
        for item in line.split() + [""]:
            word, _, label = item.rpartition("/") if item.rpartition("/")[2] in KINDS else (item, "", "O")
            if word and re.search("[0-9@+]", word):
                chain.append((word, LABELS.index(label)))
            elif chain:
                chains.append(chain)
                chain = []
    return chains


def train(chains: list[list[tuple[str, int]]] | None = None, rounds: int = 200, rate: float = 0.3,
          decay: float = 1e-3) -> Crf:
    """Gradient ascent on the penalized log-likelihood, by forward-backward over each chain."""
    chains = examples() if chains is None else chains
    index: dict[str, int] = {}
    coded = [([[index.setdefault(name, len(index)) for name in features(word)] for word, _ in chain],
              [label for _, label in chain]) for chain in chains]
    labels = len(LABELS)
    emit, move = np.zeros((len(index), labels)), np.zeros((labels, labels))
    for _ in range(rounds):
        to_emit, to_move = -decay * emit * len(coded), -decay * move * len(coded)
        for names, gold in coded:
            scores = np.array([emit[known].sum(axis=0) for known in names])
            steps = len(gold)
            forward, backward = scores.copy(), np.zeros((steps, labels))
            for step in range(1, steps):
                forward[step] += np.logaddexp.reduce(forward[step - 1][:, None] + move, axis=0)
            for step in range(steps - 2, -1, -1):
                backward[step] = np.logaddexp.reduce(move + scores[step + 1] + backward[step + 1], axis=1)
            total = np.logaddexp.reduce(forward[-1])
            for step, known in enumerate(names):
                gradient = -np.exp(forward[step] + backward[step] - total)
                gradient[gold[step]] += 1
                to_emit[known] += gradient
                if step:
                    pair = np.exp(forward[step - 1][:, None] + move + scores[step] + backward[step] - total)
                    to_move -= pair
                    to_move[gold[step - 1], gold[step]] += 1
        emit += rate * to_emit / 4
        move += rate * to_move / 4
    return Crf(index, emit.astype(np.float32), move.astype(np.float32))


def open_chains(data: bytes, text: str) -> list[list[tuple[int, int]]]:
    """Chains of neighbouring words that hold a digit, `@` or `+`, as code point ranges."""
    codes = np.frombuffer(data, np.uint8)
    marks = np.flatnonzero(_OPEN[codes])
    if not len(marks):
        return []
    blank = _BLANK[codes]
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    words = np.unique(np.searchsorted(starts, marks, side="right") - 1)
    first, last = starts[words], ends[words]
    if len(text) != len(data):
        place = np.r_[0, np.cumsum((codes & 0xC0) != 0x80)]
        first, last = place[first], place[last]
    cuts = np.flatnonzero(np.diff(words) != 1) + 1
    return [list(zip(a.tolist(), b.tolist())) for a, b in zip(np.split(first, cuts), np.split(last, cuts))]


def believable(span: str, kind: str) -> bool:
    """Whether a labelled span can be of its kind at all: the labels come from shapes alone."""
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    if kind == "email":
        return re.fullmatch(r"[^@]+@[^@]+\.[^@.]+", span) is not None
    if kind == "ip":
        return len(groups) >= 4 and all(len(group) <= 3 and int(group) <= 255 for group in groups[:4])
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return (re.fullmatch(r"[+(]?[0-9][0-9() .+-]*[0-9]", span) is not None and 9 <= len(digits) <= 15
            and len(groups) >= 3 and max(map(len, groups)) <= 5)


def added_spans(text: str, chains: list[list[tuple[int, int]]], labels: list[np.ndarray],
                base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Runs of equally labelled words, without punctuation around them, clear of base spans."""
    taken, added = sorted((start, end) for start, end, _ in base), []
    for chain, found in zip(chains, labels):
        step = 0
        while step < len(chain):
            stop = step + 1
            while stop < len(chain) and found[stop] == found[step]:
                stop += 1
            if found[step]:
                start, end = chain[step][0], chain[stop - 1][1]
                while end > start and text[end - 1] in ".,;:!?\"'#$%&*[]{}<>|":
                    end -= 1
                while end > start and text[start] in ".,;:!?\"'#$%&*[]{}<>|":
                    start += 1
                if (end > start and believable(text[start:end], LABELS[found[step]])
                        and not any(a < end and start < b for a, b in taken)):
                    added.append((start, end, LABELS[found[step]]))
            step = stop
    return added


def all_spans(data: bytes, crf: Crf) -> tuple[list, list]:
    """Base spans and all spans of a text."""
    text = data.decode("utf-8", "replace")
    chains = open_chains(data, text)
    if not chains:
        return [], []
    base = base_spans(text)
    labels = crf.decode([[text[a:b] for a, b in chain] for chain in chains])
    added = added_spans(text, chains, labels, base)
    return base, sorted(base + added, key=lambda span: (span[0], KINDS.index(span[2])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_personal_data(documents: DataFrame, crf: Crf | None = None) -> DataFrame:
    """`doc_id`, counts and digest of the base spans, and all `spans` as text, per row."""
    bound_batches(documents.sparkSession)
    crf = crf or train()

    def work(rows):
        for doc_id, data in rows:
            base, spans = all_spans(data or b"", crf)
            counts = [sum(span[2] == kind for span in base) for kind in KINDS]
            yield doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)

    schema = pa.schema([("doc_id", pa.int64()), *[(f"n_{kind}", pa.int64()) for kind in KINDS],
                        ("base_sha256", pa.string()), ("spans", pa.string())])
    ddl = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return documents.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(arrow_rows(work, schema), ddl)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """`text` with every span, overlapping ones as one, replaced by `[KIND]`."""
    out, end = [], 0
    for start, stop, kind in spans:
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def mask_personal_data(documents: DataFrame, crf: Crf | None = None) -> DataFrame:
    """`documents` with all spans of `text` masked; null texts stay null, other columns as they are.

    `n_chars`, where present, is that of the masked text.
    """
    bound_batches(documents.sparkSession)
    crf = crf or train()

    def mask(batches):
        for batch in batches:
            out = []
            for data in (text.as_py() for text in batch.column(0).cast(pa.binary())):
                if data is None:
                    out.append(None)
                    continue
                spans = all_spans(data, crf)[1]
                out.append(masked(data.decode("utf-8", "replace"), spans) if spans else data.decode("utf-8", "replace"))
            place = batch.schema.get_field_index
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()), *batch.columns[1:]],
                schema=pa.schema([pa.field("text", pa.string()), *[batch.schema.field(i) for i in range(1, batch.num_columns)]]))

    order = ["text", *[name for name in documents.columns if name != "text"]]
    schema = documents.select(*order).schema
    result = documents.select(*order).mapInArrow(mask, schema).select(*documents.columns)
    if "n_chars" in documents.columns:
        result = result.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return result
