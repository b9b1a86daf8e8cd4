"""Chat formatting by compiled templates.

A template is text with ``{{ expression }}``, ``{% if %}/{% elif %}/{% else %}/{% endif %}``,
``{% for x in xs %}/{% endfor %}`` and ``{% generation %}/{% endgeneration %}``. Expressions
have string and whole-number literals, names, fields (``message.role``, ``message['role']``),
``== != + in not and or``, parentheses and the filters below. There are no calls, no
assignments and no access to Python attributes, so a template reaches nothing but the values
it is given. It is parsed into a syntax tree, constants are folded, and each node becomes a
Python closure. Rendering yields pieces with a mark for generated text, so that a
conversation of any length is rendered turn by turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crisis_posts.llm.shared import map_rows

# The control strings of the default template, and how texts are kept clear of them: no
# escaped text holds "<" or "[".
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_LINE_ESCAPES = _ESCAPES | {"\n": "\\n"}
_PLAIN = {escaped[1]: plain for plain, escaped in _LINE_ESCAPES.items()}

DEFAULT_TEMPLATE = (
    "{% for message in messages %}"
    "{% if message.role == 'assistant' %}"
    "{{ '<s>' + 'assistant' }}\n"
    "{% generation %}{{ message.text | escape }}{% endgeneration %}</s>"
    "{% else %}"
    "{{ '[INST]' }}{{ message.role | escape_line }}\n{{ message.text | escape }}[/INST]"
    "{% endif %}"
    "{% endfor %}"
)


def escape(text: str, table: dict[str, str] = _ESCAPES) -> str:
    return text.translate(str.maketrans(table))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_line": lambda text: escape(text, _LINE_ESCAPES),
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


class TemplateError(ValueError):
    pass


# Parsing: statements and expressions as tuples (kind, ...)

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKENS = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)"
    r"|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|[+|.()\[\]])|(?P<end>$))",
    re.DOTALL,
)
_CODES = {"n": "\n", "t": "\t"}


class _Expression:
    """Precedence climbing over one expression's tokens."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while True:
            match = _TOKENS.match(source, at)
            if not match:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((match.lastgroup, match[match.lastgroup]))
            at = match.end()
            if match.lastgroup == "end":
                break

    def parse(self) -> tuple:
        tree = self.disjunction()
        if self.tokens[0][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return tree

    def take(self, *values: str) -> str | None:
        kind, value = self.tokens[0]
        if kind in ("sign", "name") and value in values:
            self.tokens.pop(0)
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def disjunction(self) -> tuple:
        left = self.conjunction()
        while self.take("or"):
            left = ("or", left, self.conjunction())
        return left

    def conjunction(self) -> tuple:
        left = self.negation()
        while self.take("and"):
            left = ("and", left, self.negation())
        return left

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> tuple:
        left = self.sum()
        sign = self.take("==", "!=", "in")
        return (sign, left, self.sum()) if sign else left

    def sum(self) -> tuple:
        left = self.filtered()
        while self.take("+"):
            left = ("+", left, self.filtered())
        return left

    def filtered(self) -> tuple:
        tree = self.field()
        while self.take("|"):
            kind, name = self.tokens.pop(0)
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def field(self) -> tuple:
        tree = self.atom()
        while sign := self.take(".", "["):
            kind, value = self.tokens.pop(0)
            if sign == "." and kind == "name":
                tree = ("field", tree, value)
            elif sign == "[" and kind == "text":
                tree = ("field", tree, _literal(value))
                self.need("]")
            else:
                raise TemplateError(f"{value!r} is no field")
        return tree

    def atom(self) -> tuple:
        if self.take("("):
            tree = self.disjunction()
            self.need(")")
            return tree
        kind, value = self.tokens.pop(0)
        if kind == "text":
            return ("constant", _literal(value))
        if kind == "number":
            return ("constant", int(value))
        if kind == "name" and value not in ("and", "or", "not", "in"):
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def _literal(quoted: str) -> str:
    return re.sub(r"\\(.)", lambda m: _CODES.get(m[1], m[1]), quoted[1:-1], flags=re.DOTALL)


def parse(template: str) -> list[tuple]:
    """The statements of a template."""
    parts, at = [], 0
    for match in _PARTS.finditer(template):
        parts.append(("text", template[at : match.start()]))
        parts.append(("print", match[1]) if match[1] is not None else ("tag", match[2].strip()))
        at = match.end()
    parts.append(("text", template[at:]))
    body, closing = _statements(iter(parts))
    if closing:
        raise TemplateError(f"{closing!r} closes nothing")
    return body


def _statements(parts: Iterator[tuple]) -> tuple[list[tuple], str]:
    """Statements up to a closing tag, and that tag."""
    body: list[tuple] = []
    for kind, source in parts:
        if kind == "text":
            body.append(("print", ("constant", source)))
        elif kind == "print":
            body.append(("print", _Expression(source).parse()))
        else:
            word, _, rest = source.partition(" ")
            if word == "if":
                body.append(_if(rest, parts))
            elif word == "for":
                match = re.fullmatch(r"([A-Za-z_]\w*) in (.+)", rest.strip())
                if not match:
                    raise TemplateError(f"can't read {source!r}")
                body.append(("for", match[1], _Expression(match[2]).parse(), _block(parts, "endfor")))
            elif word == "generation":
                body.append(("generation", _block(parts, "endgeneration")))
            elif word in ("elif", "else", "endif", "endfor", "endgeneration"):
                return body, source
            else:
                raise TemplateError(f"no statement {word!r}")
    return body, ""


def _block(parts: Iterator[tuple], end: str) -> list[tuple]:
    body, closing = _statements(parts)
    if closing != end:
        raise TemplateError(f"{end} is missing")
    return body


def _if(condition: str, parts: Iterator[tuple]) -> tuple:
    test = _Expression(condition).parse()
    body, closing = _statements(parts)
    if closing == "endif":
        return ("if", test, body, [])
    if closing == "else":
        return ("if", test, body, _block(parts, "endif"))
    if closing.startswith("elif "):
        return ("if", test, body, [_if(closing[5:], parts)])
    raise TemplateError("endif is missing")


# Folding of constants

_OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def fold_expression(tree: tuple) -> tuple:
    kind = tree[0]
    if kind in _OPERATORS:
        left, right = fold_expression(tree[1]), fold_expression(tree[2])
        if left[0] == right[0] == "constant":
            return ("constant", _OPERATORS[kind](left[1], right[1]))
        return (kind, left, right)
    if kind in ("not", "filter"):
        inner = fold_expression(tree[-1])
        if inner[0] == "constant":
            value = inner[1]
            return ("constant", not value if kind == "not" else FILTERS[tree[1]](str(value)))
        return (*tree[:-1], inner)
    return ("field", fold_expression(tree[1]), tree[2]) if kind == "field" else tree


def fold(body: list[tuple]) -> list[tuple]:
    """Constant expressions become values, settled branches go, neighbouring constants join."""
    out: list[tuple] = []
    for statement in body:
        kind = statement[0]
        if kind == "print":
            new = [("print", fold_expression(statement[1]))]
        elif kind == "if":
            test = fold_expression(statement[1])
            if test[0] == "constant":
                new = fold(statement[2] if test[1] else statement[3])
            else:
                new = [("if", test, fold(statement[2]), fold(statement[3]))]
        elif kind == "for":
            new = [("for", statement[1], fold_expression(statement[2]), fold(statement[3]))]
        else:
            new = [("generation", fold(statement[1]))]
        for item in new:
            if item[0] == "print" and item[1][0] == "constant":
                text = _text(item[1][1])
                if out and out[-1][0] == "print" and out[-1][1][0] == "constant":
                    text = out.pop()[1][1] + text
                if text:
                    out.append(("print", ("constant", text)))
            else:
                out.append(item)
    return out


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# Generation of closures

Pieces = Iterator[tuple[str, bool]]


def _evaluator(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "constant":
        value = tree[1]
        return lambda scope: value
    if kind == "name":
        name = tree[1]
        return lambda scope: scope.get(name)
    if kind == "field":
        inner, key = _evaluator(tree[1]), tree[2]

        def field(scope):
            holder = inner(scope)
            return holder.get(key) if isinstance(holder, dict) else None

        return field
    if kind == "filter":
        apply, inner = FILTERS[tree[1]], _evaluator(tree[2])
        return lambda scope: apply(_text(inner(scope)))
    if kind == "not":
        inner = _evaluator(tree[1])
        return lambda scope: not inner(scope)
    left, right = _evaluator(tree[1]), _evaluator(tree[2])
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    operator = _OPERATORS[kind]
    return lambda scope: operator(left(scope), right(scope))


def _renderer(body: list[tuple], generated: bool) -> Callable[[dict], Pieces]:
    steps = [_step(statement, generated) for statement in body]

    def render(scope: dict) -> Pieces:
        for step in steps:
            yield from step(scope)

    return render


def _step(statement: tuple, generated: bool) -> Callable[[dict], Iterable[tuple[str, bool]]]:
    kind = statement[0]
    if kind == "print":
        if statement[1][0] == "constant":
            constant = ((statement[1][1], generated),)
            return lambda scope: constant
        value = _evaluator(statement[1])
        return lambda scope: ((_text(value(scope)), generated),)
    if kind == "if":
        test = _evaluator(statement[1])
        yes, no = _renderer(statement[2], generated), _renderer(statement[3], generated)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if kind == "generation":
        return _renderer(statement[1], True)
    name, values, inner = statement[1], _evaluator(statement[2]), _renderer(statement[3], generated)

    def loop(scope: dict) -> Pieces:
        for number, item in enumerate(values(scope) or ()):
            state = {"index": number + 1, "first": number == 0}
            yield from inner(scope | {name: item, "loop": state})

    return loop


@cache
def compile_template(template: str) -> Callable[[dict], Pieces]:
    return _renderer(fold(parse(template)), False)


# Reading back, and Spark

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))


def read_turns(pieces: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, from formatted text that comes in pieces."""
    held = ""
    for piece in pieces:
        held += piece
        if "</s>" not in held and "[/INST]" not in held:
            continue
        at, opened = 0, None
        for match in _CONTROL.finditer(held):
            if match[0] in ("<s>", "[INST]"):
                opened = match.end()
            else:
                role, _, text = held[opened : match.start()].partition("\n")
                yield unescape(role), unescape(text)
                at = match.end()
        held = held[at:]


def _in_order(conversations: DataFrame) -> DataFrame:
    """The rows of a conversation in one partition, by turn; ties by role, then text."""
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn",
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )


def _messages(group: Iterable[tuple]) -> Iterator[dict[str, str]]:
    return ({"role": role.decode(), "text": text.decode()} for _, role, text in group)


def format_conversations(
    conversations: DataFrame, template: str = DEFAULT_TEMPLATE
) -> DataFrame:
    """(conv_id, part, text, loss): the formatted text of each conversation, in numbered parts.

    A part is a stretch of text all of which is, or is not, under the loss mask; joined by
    number, the parts of a conversation are its formatted text. Rows come by turn, equal turns
    by role and text; null roles and texts count as empty; rows without conv_id are one
    conversation of their own. Other columns are not looked at. A conversation is rendered
    turn by turn, so its length is not bounded by memory.
    """

    def rows_of(rows):
        render = compile_template(template)
        for conv, group in groupby(rows, itemgetter(0)):
            scope = {"messages": _messages(group)}
            runs = groupby(render(scope), itemgetter(1))
            for part, (loss, pieces) in enumerate(runs):
                for text, _ in pieces:
                    yield conv, part, text, loss

    schema = "conv_id long, part long, text string, loss boolean"
    return map_rows(_in_order(conversations), schema, rows_of)


def conversation_digests(
    conversations: DataFrame, template: str = DEFAULT_TEMPLATE
) -> DataFrame:
    """Digests read back from the formatted text, one row for each conversation.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): the turns'
    digest is over role, newline, text, newline of each; the loss digest is over the unescaped
    text under the loss mask. Rows and nulls are treated as in format_conversations. Digests
    grow by turn; a conversation is never held whole.
    """

    def rows_of(rows):
        render = compile_template(template)
        for conv, group in groupby(rows, itemgetter(0)):
            turns, loss, counts = hashlib.sha256(), hashlib.sha256(), [0, 0, 0]

            def written(group=group, loss=loss, counts=counts):
                for text, generated in render({"messages": _messages(group)}):
                    counts[0] += len(text)
                    if generated:
                        plain = unescape(text)
                        counts[1] += len(plain)
                        loss.update(plain.encode())
                    yield text

            for role, text in read_turns(written()):
                counts[2] += 1
                turns.update(f"{role}\n{text}\n".encode())
            yield conv, counts[2], turns.hexdigest(), counts[1], loss.hexdigest(), counts[0]

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return map_rows(_in_order(conversations), schema, rows_of)
