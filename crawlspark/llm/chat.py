"""Chat formatting by compiled templates, with generation masks, and reading the formatted text back.

A template is parsed into a syntax tree, constants are folded, and every node becomes a Python
closure. The language is a sandbox: literal text, `{{ expression }}`, `{# comment #}`, `{% if %}` with `elif` and
`else`, `{% for name in messages %}`, `{% generation %}`. Expressions know strings, numbers, declared constants,
`message.role`, `message.text`, `== != in + and or not`, and the filters of `FILTERS`. There are no calls, no
attributes of Python objects and no loops but over the messages; anything else is a `TemplateError` when compiled.

The body of the loop sees one message at a time, so every row of a conversation is rendered by
itself, without a shuffle, however long the conversation is. What comes before and after the loop are pieces of their own.
Text between `generation` marks is listed as spans of code points of its piece. Only reading back brings the pieces
of a conversation together, in order, as a stream: a digest over all turns has to pass them one by one, but
no task holds more than a batch and one turn.

Control strings in texts are escaped: a backslash follows their first character, and backslashes are doubled.

Null texts and roles are empty. Null turns come first; rows of equal turn follow role, then a hash of the text. Repeated
rows are turns of their own. Rows without conv_id form one conversation. Malformed UTF-8 becomes
replacement characters. An empty table gives an empty result. Columns other than conv_id, turn, role and text are
not looked at.
"""

import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, bound_batches


class TemplateError(ValueError):
    pass


# --- syntax tree ---

@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Field:
    name: str


@dataclass(frozen=True)
class Operation:
    name: str
    parts: tuple


@dataclass(frozen=True)
class Choice:
    condition: Any
    then: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


LEXEME = re.compile(r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<sign>==|!=|[.+|()]))""", re.S)
TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
WORDS = {"true": True, "false": False, "none": None}


class _Parser:
    """Recursive descent over the tags of a template."""

    def __init__(self, source: str, constants: dict, filters: dict):
        self.constants, self.filters, self.scope = constants, filters, []
        self.items, end = [], 0
        for tag in TAG.finditer(source):
            text = source[end:tag.start()]
            # A dash inside the braces drops the blanks on its side.
            if self.items and self.items[-1] == ("trim", ""):
                text = text.lstrip()
            self.items.append(("text", text.rstrip() if tag[0][2] == "-" else text))
            kind = "print" if tag[1] is not None else "block" if tag[2] is not None else "text"
            self.items.append((kind, tag[1] if tag[1] is not None else tag[2] or ""))
            if kind != "text" and tag[0][-3] == "-":
                self.items.append(("trim", ""))
            end = tag.end()
        rest = source[end:]
        self.items.append(("text", rest.lstrip() if self.items and self.items[-1] == ("trim", "") else rest))
        if any(mark in text for kind, text in self.items if kind == "text" for mark in ("{{", "{%", "{#")):
            raise TemplateError("a tag is not closed")
        self.place = 0

    def template(self) -> tuple:
        nodes, ended = self.nodes(())
        assert ended is None
        return nodes

    def nodes(self, ends: tuple) -> tuple[tuple, str | None]:
        """Nodes up to a block that starts with one of `ends`, and that block."""
        found = []
        while self.place < len(self.items):
            kind, text = self.items[self.place]
            self.place += 1
            if kind == "text":
                found.append(Constant(text))
            elif kind == "print":
                found.append(self.expression(text))
            elif kind == "block":
                word, _, rest = text.strip().partition(" ")
                if word in ends:
                    return tuple(found), text.strip()
                found.append(self.block(word, rest))
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(found), None

    def block(self, word: str, rest: str):
        if word == "if":
            return self.choice(rest)
        if word == "generation" and not rest.strip():
            body, _ = self.nodes(("endgeneration",))
            return Generation(body)
        if word == "for":
            parts = rest.split()
            if len(parts) != 3 or parts[1:] != ["in", "messages"] or not parts[0].isidentifier():
                raise TemplateError("a loop reads: for name in messages")
            if self.scope:
                raise TemplateError("loops are not nested")
            self.scope.append(parts[0])
            body, _ = self.nodes(("endfor",))
            self.scope.pop()
            return Loop(parts[0], body)
        raise TemplateError(f"unknown block {word!r}")

    def choice(self, condition: str) -> Choice:
        test = self.expression(condition)
        then, ended = self.nodes(("elif", "else", "endif"))
        if ended.startswith("elif"):
            return Choice(test, then, (self.choice(ended[4:]),))
        if ended == "else":
            otherwise, _ = self.nodes(("endif",))
            return Choice(test, then, otherwise)
        return Choice(test, then, ())

    # Expressions, loosest first.

    def expression(self, text: str):
        self.lexemes, end = [], 0
        while text[end:].strip():
            lexeme = LEXEME.match(text, end)
            if not lexeme:
                raise TemplateError(f"cannot read {text[end:].strip()!r}")
            self.lexemes.append((lexeme.lastgroup, lexeme[lexeme.lastgroup]))
            end = lexeme.end()
        self.lexemes.reverse()
        found = self.either()
        if self.lexemes:
            raise TemplateError(f"{self.lexemes[-1][1]!r} is too much")
        return found

    def accept(self, *texts: str) -> str | None:
        if self.lexemes and self.lexemes[-1][0] in ("sign", "name") and self.lexemes[-1][1] in texts:
            return self.lexemes.pop()[1]
        return None

    def either(self):
        left = self.both()
        while self.accept("or"):
            left = Operation("or", (left, self.both()))
        return left

    def both(self):
        left = self.negation()
        while self.accept("and"):
            left = Operation("and", (left, self.negation()))
        return left

    def negation(self):
        return Operation("not", (self.negation(),)) if self.accept("not") else self.comparison()

    def comparison(self):
        left = self.sum()
        while sign := self.accept("==", "!=", "in"):
            left = Operation(sign, (left, self.sum()))
        return left

    def sum(self):
        left = self.filtered()
        while self.accept("+"):
            left = Operation("+", (left, self.filtered()))
        return left

    def filtered(self):
        value = self.atom()
        while self.accept("|"):
            name = self.lexemes.pop()[1] if self.lexemes else ""
            if name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            value = Operation(f"|{name}", (value,))
        return value

    def atom(self):
        if self.accept("("):
            inner = self.either()
            if not self.accept(")"):
                raise TemplateError(") is missing")
            return inner
        kind, text = self.lexemes.pop() if self.lexemes else ("", "")
        if kind == "string":
            return Constant(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Constant(int(text))
        if kind == "name" and text in WORDS:
            return Constant(WORDS[text])
        if kind == "name" and text in self.constants:
            return Constant(self.constants[text])
        if kind == "name" and text in self.scope:
            if not self.accept("."):
                raise TemplateError(f"{text} is used without a field")
            name = self.lexemes.pop()[1] if self.lexemes else ""
            if name not in ("role", "text"):
                raise TemplateError(f"a message has no field {name!r}")
            return Field(name)
        raise TemplateError(f"unknown name {text!r}")


def _text(value: Any) -> str:
    return "" if value is None else str(value)


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: _text(a) in _text(b),
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda value: _text(value).strip(), "upper": lambda value: _text(value).upper(),
    "lower": lambda value: _text(value).lower(), "length": lambda value: len(_text(value)),
}


def fold(node, operators: dict):
    """The node without operations on constants and without choices already made."""
    if isinstance(node, tuple):
        merged = []
        for part in node:
            part = fold(part, operators)
            for inner in part if isinstance(part, tuple) else (part,):
                if isinstance(inner, Constant):
                    inner = Constant(_text(inner.value))
                    if merged and isinstance(merged[-1], Constant):
                        inner = Constant(merged.pop().value + inner.value)
                    if not inner.value:
                        continue
                merged.append(inner)
        return tuple(merged)
    if isinstance(node, Operation):
        parts = tuple(fold(part, operators) for part in node.parts)
        if all(isinstance(part, Constant) for part in parts):
            return Constant(operators[node.name](*[part.value for part in parts]))
        return Operation(node.name, parts)
    if isinstance(node, Choice):
        condition = fold(node.condition, operators)
        if isinstance(condition, Constant):
            return fold(node.then if condition.value else node.otherwise, operators)
        return Choice(condition, fold(node.then, operators), fold(node.otherwise, operators))
    if isinstance(node, Loop):
        return Loop(node.name, fold(node.body, operators))
    if isinstance(node, Generation):
        return Generation(fold(node.body, operators))
    return node


@dataclass
class Piece:
    """Rendered text and the spans of it that are generated, in code points."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    @property
    def text(self) -> str:
        return "".join(self.parts)


def _value(node, operators: dict) -> Callable[[dict | None], Any]:
    if isinstance(node, Constant):
        return lambda message, value=node.value: value
    if isinstance(node, Field):
        return lambda message, name=node.name: message[name]
    work, parts = operators[node.name], [_value(part, operators) for part in node.parts]
    if len(parts) == 1:
        return lambda message, only=parts[0]: work(only(message))
    left, right = parts
    # `and` and `or` may look at both sides: expressions have no effects.
    return lambda message: work(left(message), right(message))


def _writer(node, operators: dict) -> Callable[[dict | None, Piece], None]:
    if isinstance(node, tuple):
        writers = [_writer(part, operators) for part in node]

        def write_all(message, piece):
            for write in writers:
                write(message, piece)

        return write_all
    if isinstance(node, Choice):
        test = _value(node.condition, operators)
        then, otherwise = _writer(node.then, operators), _writer(node.otherwise, operators)
        return lambda message, piece: (then if test(message) else otherwise)(message, piece)
    if isinstance(node, Generation):
        inner = _writer(node.body, operators)

        def write_span(message, piece):
            start = piece.size
            inner(message, piece)
            piece.spans.append((start, piece.size))

        return write_span
    if isinstance(node, Loop):
        raise TemplateError("the loop is not within another block")
    if isinstance(node, Constant):
        return lambda message, piece, text=_text(node.value): piece.add(text)
    value = _value(node, operators)
    return lambda message, piece: piece.add(_text(value(message)))


class Template:
    """A compiled template: closures for what precedes the loop, for one message, and for what follows."""

    def __init__(self, source: str, constants: dict[str, Any] | None = None, filters: dict[str, Callable] | None = None):
        filters = {**FILTERS, **(filters or {})}
        operators = {**OPERATORS, **{f"|{name}": work for name, work in filters.items()}}
        nodes = fold(_Parser(source, constants or {}, filters).template(), operators)
        loops = [place for place, node in enumerate(nodes) if isinstance(node, Loop)]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over the messages")
        self.nodes = nodes
        self._opening = _writer(nodes[:loops[0]], operators)
        self._message = _writer(nodes[loops[0]].body, operators)
        self._closing = _writer(nodes[loops[0] + 1:], operators)

    def opening(self) -> Piece:
        return self._piece(self._opening, None)

    def message(self, role: str, text: str) -> Piece:
        return self._piece(self._message, {"role": role, "text": text})

    def closing(self) -> Piece:
        return self._piece(self._closing, None)

    def render(self, messages: Iterable[tuple[str, str]]) -> Piece:
        """A whole conversation as one piece."""
        whole = Piece()
        for piece in (self.opening(), *[self.message(role, text) for role, text in messages], self.closing()):
            whole.spans += [(whole.size + start, whole.size + end) for start, end in piece.spans]
            whole.add(piece.text)
        return whole

    @staticmethod
    def _piece(write: Callable, message: dict | None) -> Piece:
        piece = Piece()
        write(message, piece)
        return piece


# --- a format: a template, its control strings, and how turns are read back ---

class ChatFormat:
    """A template with its control strings; `turns` lists (opening, role, closing), role None where the text names it.

    Where the role is None, the opening is a pair: what precedes the role, and what separates it from the text.
    """

    def __init__(self, source: str, constants: dict[str, str], controls: tuple[str, ...],
                 turns: tuple[tuple, ...]):
        heads = {control[0] for control in controls} | {"\\"}
        if any(head in control[1:] for control in controls for head in heads):
            raise TemplateError("the first character of a control string occurs inside one")
        tails = "|".join(f"{re.escape(control[0])}(?={re.escape(control[1:])})" for control in controls)
        self._to_escape = re.compile(rf"\\|{tails}")
        self.source, self.constants = source, constants
        inside = r"(.*?)"
        ways = [re.escape(opening) + inside + re.escape(closing) if role is not None
                else re.escape(opening[0]) + inside + re.escape(opening[1]) + inside + re.escape(closing)
                for opening, role, closing in turns]
        self.turns, self._turn = turns, re.compile("|".join(f"(?:{way})" for way in ways), re.S)

    def compiled(self) -> Template:
        return Template(self.source, self.constants, {"escape": lambda value: self.escape(_text(value))})

    def escape(self, text: str) -> str:
        return self._to_escape.sub(lambda found: found[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def read_turns(self, text: str) -> tuple[list[tuple[str, str]], str]:
        """Whole turns at the start of a formatted text, and what is left after them."""
        found, end = [], 0
        while turn := self._turn.match(text, end):
            groups, place = turn.groups(), 0
            for _, role, _ in self.turns:
                width = 1 if role is not None else 2
                if groups[place] is not None:
                    parts = [self.unescape(group) for group in groups[place:place + width]]
                    found.append((role, parts[0]) if role is not None else (parts[0], parts[1]))
                    break
                place += width
            end = turn.end()
        return found, text[end:]


INSTRUCT = ChatFormat(
    "{{ bos }}{% for message in messages %}"
    "{% if message.role == 'user' %}[INST]{{ message.text | escape }}[/INST]"
    "{% elif message.role == 'assistant' %}<|assistant|>"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}{{ eos }}"
    "{% else %}<|role|>{{ message.role | escape }}<|text|>{{ message.text | escape }}{{ eos }}{% endif %}"
    "{% endfor %}",
    {"bos": "<s>", "eos": "</s>"},
    ("<s>", "</s>", "[INST]", "[/INST]", "<|assistant|>", "<|role|>", "<|text|>"),
    (("[INST]", "user", "[/INST]"), ("<|assistant|>", "assistant", "</s>"), (("<|role|>", "<|text|>"), None, "</s>")))

#: Nulls come first.
ORDER = ("conv_id", "part", "turn", "role", "text_key")
PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("turn", pa.int64()), ("role", pa.string()),
                    ("text_key", pa.int64()), ("piece", pa.string()), ("spans", pa.list_(pa.int64()))])
PIECES_DDL = "conv_id bigint, part int, turn bigint, role string, text_key bigint, piece string, spans array<bigint>"


def formatted(conversations: DataFrame, chat: ChatFormat = INSTRUCT) -> DataFrame:
    """Pieces of formatted text: `conv_id`, `part` (0 before the messages, 1 a message, 2 after them), `turn`, `role`,
    `text_key` (their order within a part), `piece`, `spans` (start and end of every generated stretch, one after the other).

    Rows are rendered where they are read; a conversation is its pieces in the order of `ORDER`.
    """

    def spans(piece):
        return [bound for span in piece.spans for bound in span]

    def messages(rows):
        template = chat.compiled()
        for conv_id, turn, role, text_key, text in rows:
            role = role.decode("utf-8", "replace")
            piece = template.message(role, text.decode("utf-8", "replace"))
            yield conv_id, 1, turn, role, text_key, piece.text, spans(piece)

    def frames(rows):
        template = chat.compiled()
        for conv_id, in rows:
            for part, piece in ((0, template.opening()), (2, template.closing())):
                if piece.size:
                    yield conv_id, part, None, "", 0, piece.text, spans(piece)

    bound_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.xxhash64("text").alias("text_key"),
        F.coalesce("text", F.lit("")).alias("text"))
    bodies = rows.mapInArrow(arrow_rows(messages, PIECES, flush_rows=2000), PIECES_DDL)
    return bodies.union(rows.select("conv_id").distinct().mapInArrow(arrow_rows(frames, PIECES), PIECES_DDL))


READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                  ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(pieces: DataFrame, chat: ChatFormat = INSTRUCT) -> DataFrame:
    """Per conversation what its formatted text says: `n_turns`, `turns_sha256` (role, newline, text, newline per
    turn), `loss_chars` and `loss_sha256` of the unescaped text in generated spans, `formatted_chars`."""

    def work(rows):
        opening, closing = (piece.text for piece in (chat.compiled().opening(), chat.compiled().closing()))
        for conv_id, group in groupby(rows, key=lambda row: row[0]):
            turns, loss, n_turns, loss_chars, n_chars, rest, at_start = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, "", True
            for _, piece, spans in group:
                piece = piece.decode()
                n_chars += len(piece)
                for start, end in zip(spans[::2], spans[1::2]):
                    text = chat.unescape(piece[start:end])
                    loss_chars += len(text)
                    loss.update(text.encode())
                rest += piece
                if at_start and rest.startswith(opening):
                    rest, at_start = rest[len(opening):], False
                found, rest = chat.read_turns(rest)
                for role, text in found:
                    n_turns += 1
                    turns.update(f"{role}\n{text}\n".encode())
            if rest != closing:
                raise ValueError(f"conversation {conv_id}: cannot read {rest[:80]!r}")
            yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), n_chars

    ordered = pieces.repartition("conv_id").sortWithinPartitions(*ORDER).select("conv_id", "piece", "spans")
    return ordered.mapInArrow(arrow_rows(work, READ), "conv_id bigint, n_turns bigint, turns_sha256 string, "
                                                      "loss_chars bigint, loss_sha256 string, formatted_chars bigint")
