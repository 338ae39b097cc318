"""Chat templates: a small sandboxed template language, compiled to Python closures.

A template is read into a syntax tree, constants are folded, and each node becomes a closure that
yields segments of output. ``{% generation %}`` marks text that a model should learn to produce.
Rendering is a stream: ``messages`` is read once, in order, so a conversation of any length needs
the memory of one turn. The sandbox has no calls, no attributes but the keys of given mappings, and
only the filters in ``FILTERS``.
"""

import re
from collections.abc import Mapping
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


class TemplateError(ValueError):
    pass


#: Strings that mark turns. None holds another's first character but at its start.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ASST]", "[ROLE]", "[SAYS]", "[/ROLE]")
_SHIELD = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_UNSHIELD = re.compile(r"\\(.)", re.S)


def shield(text: str) -> str:
    """Control strings broken by a backslash after their first character, backslashes doubled."""
    if "\\" not in text and "[" not in text and "<" not in text:
        return text
    return _SHIELD.sub(lambda m: "\\\\" if m.group() == "\\" else m.group()[0] + "\\" + m.group()[1:], text)


def unshield(text: str) -> str:
    return _UNSHIELD.sub(r"\1", text) if "\\" in text else text


FILTERS = {
    "shield": shield, "trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len,
    "string": lambda v: shown(v), "default": lambda v, other="": other if v is None else v,
    "replace": lambda v, a, b: v.replace(a, b),
}

TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}{{ '[INST] ' }}{{ m.text | shield }}{{ ' [/INST]' }}"
    "{% elif m.role == 'assistant' %}{{ '[ASST]' }}{% generation %}{{ m.text | shield }}{% endgeneration %}{{ '</s>' }}"
    "{% else %}{{ '[ROLE]' }}{{ m.role | shield }}{{ '[SAYS]' }}{{ m.text | shield }}{{ '[/ROLE]' }}"
    "{% endif %}{% endfor %}")

_BLOCK = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<num>\d+)|(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|//|[-+*%~<>()\[\],.|]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_LITERALS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


def shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b, "not in": lambda a, b: a not in b,
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "//": lambda a, b: a // b,
    "%": lambda a, b: a % b, "~": lambda a, b: shown(a) + shown(b),
}
_LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", ">", "<=", ">=", "in", "not in"), ("+", "-", "~"), ("*", "//", "%"))


class _Expression:
    """Recursive descent over one expression; yields nodes as tuples."""

    def __init__(self, source):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self, *values):
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            return kind != "str" and value in values
        return False

    def take(self, *values):
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value):
        if not self.take(value):
            raise TemplateError(f"expected {value!r}")

    def name(self):
        if self.at == len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        node = self.level(0)
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def level(self, k):
        if k == len(_LEVELS):
            return self.postfix()
        if _LEVELS[k] == ("not",):
            return ("not", self.level(k)) if self.take("not") else self.level(k + 1)
        node = self.level(k + 1)
        while True:
            if "not in" in _LEVELS[k] and self.peek("not"):
                self.take("not")
                self.need("in")
                op = "not in"
            else:
                op = self.take(*_LEVELS[k])
            if not op:
                return node
            node = (op if op in ("and", "or") else "binary", op, node, self.level(k + 1))

    def postfix(self):
        node = self.atom()
        while True:
            if self.take("."):
                node = ("get", node, ("const", self.name()))
            elif self.take("["):
                node = ("get", node, self.level(0))
                self.need("]")
            elif self.take("|"):
                name, args = self.name(), []
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.level(0))
                        self.take(",")
                node = ("filter", name, node, args)
            else:
                return node

    def atom(self):
        if self.take("("):
            node = self.level(0)
            self.need(")")
            return node
        if self.take("-"):
            return ("binary", "-", ("const", 0), self.postfix())
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "num":
            return ("const", int(value))
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "name":
            return ("const", _LITERALS[value]) if value in _LITERALS else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list:
    """The syntax tree: a list of statements."""
    parts = _BLOCK.split(source)
    for i in range(1, len(parts), 2):
        if parts[i][2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    at = 0

    def body(ends):
        nonlocal at
        out = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if at % 2:
                if part:
                    out.append(("text", part))
                continue
            inner = part[2:-2].strip("-").strip()
            if part.startswith("{#"):
                continue
            if part.startswith("{{"):
                out.append(("print", _Expression(inner).whole()))
                continue
            word, _, rest = inner.partition(" ")
            if word in ends:
                return out, word, rest
            if word == "if":
                arms, other, test = [], [], rest
                while True:
                    inside, word, rest = body(("elif", "else", "endif"))
                    arms.append((_Expression(test).whole(), inside))
                    if word == "elif":
                        test = rest
                        continue
                    if word == "else":
                        other, _, _ = body(("endif",))
                    break
                out.append(("if", arms, other))
            elif word == "for":
                head = _Expression(rest)
                name = head.name()
                head.need("in")
                inside, _, _ = body(("endfor",))
                out.append(("for", name, head.whole(), inside))
            elif word == "set":
                head = re.match(r"([A-Za-z_]\w*)\s*=(.*)", rest, re.S)
                if not head:
                    raise TemplateError(f"cannot read set {rest!r}")
                out.append(("set", head[1], _Expression(head[2]).whole()))
            elif word == "generation":
                inside, _, _ = body(("endgeneration",))
                out.append(("generation", inside))
            else:
                raise TemplateError(f"unknown statement {word!r}")
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return out, None, None

    return body(())[0]


def fold(node):
    """An expression with its constant parts computed."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        node = (kind, node[1], fold(node[2]), [fold(a) for a in node[3]])
        parts = [node[2], *node[3]]
    else:
        node = tuple(fold(x) if isinstance(x, tuple) else x for x in node)
        parts = [x for x in node if isinstance(x, tuple)]
    return ("const", _value(node)({})) if all(p[0] == "const" for p in parts) else node


def fold_body(body: list) -> list:
    """Statements with constant output as text, neighbouring texts joined, decided branches chosen."""
    out = []
    for node in body:
        kind = node[0]
        if kind == "print":
            value = fold(node[1])
            node = ("text", shown(value[1])) if value[0] == "const" else ("print", value)
        elif kind == "set":
            node = ("set", node[1], fold(node[2]))
        elif kind == "for":
            node = ("for", node[1], fold(node[2]), fold_body(node[3]))
        elif kind == "generation":
            node = ("generation", fold_body(node[1]))
        elif kind == "if":
            arms, other = [], fold_body(node[2])
            for test, inside in node[1]:
                test = fold(test)
                if test[0] != "const":
                    arms.append((test, fold_body(inside)))
                elif test[1]:
                    other = fold_body(inside)
                    break
            if not arms:
                out += other
                continue
            node = ("if", arms, other)
        if node[0] == "text" and out and out[-1][0] == "text":
            node = ("text", out.pop()[1] + node[1])
        if node != ("text", ""):
            out.append(node)
    return out


def _value(node):
    """A closure from the scope to the expression's value."""
    kind = node[0]
    if kind == "const":
        return lambda scope, v=node[1]: v
    if kind == "name":
        return lambda scope, k=node[1]: scope.get(k)
    if kind == "not":
        return lambda scope, f=_value(node[1]): not f(scope)
    if kind == "and":
        return lambda scope, a=_value(node[2]), b=_value(node[3]): a(scope) and b(scope)
    if kind == "or":
        return lambda scope, a=_value(node[2]), b=_value(node[3]): a(scope) or b(scope)
    if kind == "binary":
        return lambda scope, op=_BINARY[node[1]], a=_value(node[2]), b=_value(node[3]): op(a(scope), b(scope))
    if kind == "filter":
        return lambda scope, f=FILTERS[node[1]], a=_value(node[2]), more=[_value(x) for x in node[3]]: f(a(scope), *(m(scope) for m in more))

    def get(scope, a=_value(node[1]), b=_value(node[2])):
        box, k = a(scope), b(scope)
        if isinstance(box, Mapping):
            return box.get(k)
        if isinstance(box, (list, tuple, str)) and isinstance(k, int):
            return box[k]
        raise TemplateError(f"no item {k!r}")
    return get


#: Yielded after each round of an outermost loop: output may be cut there.
CUT = (None, False)


def _block(body, depth=0):
    """A closure from (scope, inside a generation mark) to segments (text, learned)."""
    steps = []
    for node in body:
        kind = node[0]
        if kind == "text":
            steps.append(lambda scope, gen, t=node[1]: ((t, gen),))
        elif kind == "print":
            steps.append(lambda scope, gen, f=_value(node[1]): ((shown(f(scope)), gen),))
        elif kind == "set":
            def assign(scope, gen, k=node[1], f=_value(node[2])):
                scope[k] = f(scope)
                return ()
            steps.append(assign)
        elif kind == "generation":
            steps.append(lambda scope, gen, f=_block(node[1], depth + 1): f(scope, True))
        elif kind == "if":
            def choose(scope, gen, arms=[(_value(t), _block(b, depth + 1)) for t, b in node[1]], other=_block(node[2], depth + 1)):
                return next((b for t, b in arms if t(scope)), other)(scope, gen)
            steps.append(choose)
        else:
            def loop(scope, gen, k=node[1], f=_value(node[2]), inside=_block(node[3], depth + 1), outer=depth == 0):
                items = iter(f(scope) or ())
                item, more, index = next(items, None), True, 0
                ended = object()
                if item is None:
                    return
                while more:
                    after = next(items, ended)
                    more = after is not ended
                    own = dict(scope)
                    own[k], own["loop"] = item, {"index0": index, "index": index + 1, "first": not index, "last": not more}
                    yield from inside(own, gen)
                    if outer:
                        yield CUT
                    item, index = after, index + 1
            steps.append(loop)

    def run(scope, gen):
        for step in steps:
            yield from step(scope, gen)
    return run


def compiled(source: str):
    """``render(messages, **more)`` yields segments (text, learned), and ``CUT`` where output may be cut."""
    run = _block(fold_body(parse(source)))
    return lambda messages, **more: run({"messages": messages, **more}, False)


PART_CHARS = 1 << 16


def parts(segments, size: int = PART_CHARS):
    """(text, learned spans) parts of about ``size`` characters, cut only where the template allows."""
    held, spans, n = [], [], 0
    for text, learned in segments:
        if text is None:
            if n >= size:
                yield "".join(held), spans
                held, spans, n = [], [], 0
            continue
        if learned:
            if spans and spans[-1][1] == n and text:
                spans[-1] = (spans[-1][0], n + len(text))
            elif text:
                spans.append((n, n + len(text)))
        held.append(text)
        n += len(text)
    if held or spans:
        yield "".join(held), spans


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def format_chat(turns: DataFrame, template: str = TEMPLATE, key: str = "conv_id") -> DataFrame:
    """Rows (key, part, formatted, learned): conversations rendered in parts, learned spans in code points.

    Turns come in the order of turn, role, text; null roles and texts count as empty, null turns come
    first, repeated rows are turns of their own, rows with a null key form one conversation. An empty
    table gives no rows; columns other than the four are not read. A conversation is rendered by one
    task as a stream: sorted rows in, parts out, so its length costs no memory.
    """
    kind = turns.schema[key].dataType.simpleString()
    rows = turns.select(F.col(key).alias("key"), F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = pa.schema([("part", pa.int64()), ("formatted", pa.string()),
                        ("learned", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def run(batches):
        render, kinds = compiled(template), []

        def seen():
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type]
                yield batch

        def flush(held):
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], kinds[0])] + [
                pa.array([h[i + 1] for h in held], schema.field(i).type) for i in range(3)], names=["key", *schema.names])

        held, size = [], 0
        for conv, group in groupby(_rows(seen()), key=lambda r: r[0]):
            messages = ({"role": r[2], "text": r[3]} for r in group)
            for n, (text, spans) in enumerate(parts(render(messages))):
                held.append((conv, n, text, [{"start": a, "end": b} for a, b in spans]))
                size += len(text)
                if size > 4_000_000 or len(held) == 5000:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return (rows.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
            .mapInArrow(run, f"key {kind}, part long, formatted string, learned array<struct<start:int,end:int>>")
            .withColumnRenamed("key", key))


_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|\[ASST\](?P<assistant>.*?)</s>|\[ROLE\](?P<role>.*?)\[SAYS\](?P<text>.*?)\[/ROLE\]", re.S)


def turns_of(formatted: str):
    """(role, text) of each turn of an output of ``TEMPLATE``."""
    over = 0
    for m in _TURN.finditer(formatted):
        if m.start() != over:
            raise ValueError(f"no turn begins at character {over}")
        over = m.end()
        if m["role"] is not None:
            yield unshield(m["role"]), unshield(m["text"])
        else:
            yield m.lastgroup, unshield(m[m.lastgroup])
    if over != len(formatted):
        raise ValueError(f"no turn begins at character {over}")


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """Digests of each conversation, from the output of ``format_chat`` with ``TEMPLATE`` alone.

    Hashes take the parts in order as a stream. Directly on that output no further shuffle is needed.
    """
    import hashlib
    kind = formatted.schema[key].dataType.simpleString()
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        kinds = []

        def seen():
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type]
                yield batch

        held = []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], kinds[0])] + [
                pa.array([h[i + 1] for h in held], t) for i, t in enumerate(types)], names=["key", *names])

        for conv, group in groupby(_rows(seen()), key=lambda r: r[0]):
            turns, loss, n, chars, lost = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, _, text, spans in group:
                chars += len(text)
                for role, said in turns_of(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    said = unshield(text[span["start"]:span["end"]])
                    lost += len(said)
                    loss.update(said.encode("utf-8", "surrogatepass"))
            held.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars))
            if len(held) == 5000:
                yield flush()
                held.clear()
        if held:
            yield flush()

    return (formatted.select(F.col(key).alias("key"), "part", "formatted", "learned")
            .mapInArrow(run, f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
            .withColumnRenamed("key", key))
