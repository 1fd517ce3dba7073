"""A tokenizer's own chat template as a Column expression.

A chat template is a text with tags: ``{% for %}``, ``{% if %}``, ``{% set %}`` and
``{{ value }}``. :func:`compile_template` reads it once and gives a function of the
columns ``messages`` and ``tools``: a loop becomes ``transform`` and ``array_join``, a
branch ``when``, a variable the expression it stands for. Nothing of it runs in
Python while rows are read.

Values are text, whole numbers, truth values, lists of messages, and VARIANT for tools
and tool calls. Known are indexes, slices and fields, ``loop.first``, ``last``, ``index``
and ``index0``, comparisons, ``in``, ``and``, ``or``, ``not``, ``+``, ``~``, ``%``, ``a if b else c``,
the filters and methods in ``TEXT_RULES``, ``length``, ``startswith``, ``endswith``, ``split``,
tests such as ``is defined``, and ``raise_exception``. Anything else, ``namespace``, ``tojson`` and
macros among it, is refused when the template is compiled, so that no row gets a
wrong text; pass a pandas UDF for such a template.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunelake.functions.pytext import SPACE_CHARS, strip, truthy

QUOTED = r"'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\""
TAG = re.compile(
    rf"\{{%(?P<l1>[-+]?)(?P<block>(?:{QUOTED}|.)*?)(?P<r1>-?)%\}}"
    rf"|\{{\{{(?P<l2>-?)(?P<value>(?:{QUOTED}|.)*?)(?P<r2>-?)\}}\}}"
    r"|\{#(?P<l3>-?).*?(?P<r3>-?)#\}", re.DOTALL)
OPERATOR = re.compile(rf"({QUOTED})|\||~")
# Filters and methods that make text of text, with the same result under either spelling.
TEXT_RULES: dict[str, Callable[[Column], Column]] = {
    "trim": strip, "strip": strip, "upper": F.upper, "lower": F.lower, "string": lambda c: c,
    "lstrip": lambda c: F.ltrim(c, F.lit(SPACE_CHARS)), "rstrip": lambda c: F.rtrim(c, F.lit(SPACE_CHARS)),
}


class Value(NamedTuple):
    """A template's value: its kind, and a Column or, for tuples and ``loop``, what they hold."""

    kind: str
    held: Any = None


UNDEFINED, NONE = Value("undefined"), Value("none")
Env = dict[str, Value]


def unknown(what: str) -> ValueError:
    return ValueError(f"the template uses {what}, which has no column form")


def constant(x: object) -> Value:
    if x is None:
        return NONE
    if isinstance(x, bool):
        return Value("bool", F.lit(x))
    if isinstance(x, int):
        return Value("int", F.lit(x))
    if isinstance(x, str):
        return Value("text", F.lit(x))
    raise unknown(repr(x))


def shown(v: Value) -> Column:
    """A value as the template writes it: nothing for what is not there, ``None`` for null."""
    if v.kind == "undefined":
        return F.lit("")
    if v.kind == "none":
        return F.lit("None")
    if v.kind == "bool":
        return F.when(v.held, "True").otherwise("False")
    if v.kind == "int":
        return v.held.cast("string")
    if v.kind == "text":
        return F.coalesce(v.held, F.lit("None"))
    if v.kind == "refused":
        return v.held
    if v.kind == "variant":
        plain = F.schema_of_variant(v.held).isin("STRING", "BIGINT")
        wrong = F.raise_error(F.lit("a chat template writes a value that is neither text nor a whole number")).cast("string")
        return F.when(v.held.isNull(), "").when(F.is_variant_null(v.held), "None").when(
            plain, F.try_variant_get(v.held, "$", "string")).otherwise(wrong)
    raise unknown(f"a value of kind {v.kind} as text")


def is_true(v: Value) -> Column:
    if v.kind in ("undefined", "none"):
        return F.lit(False)
    if v.kind == "bool":
        return v.held
    if v.kind == "int":
        return v.held != 0
    if v.kind == "text":
        return truthy(v.held)
    if v.kind in ("messages", "variants", "texts"):
        return F.coalesce(F.size(v.held) > 0, F.lit(False))
    if v.kind == "message":
        return v.held.isNotNull()
    if v.kind == "variant":
        return F.coalesce(~F.to_json(v.held).isin("null", "[]", "{}", '""', "false", "0"), F.lit(False))
    raise unknown(f"a value of kind {v.kind} as a condition")


def truth(c: Column) -> Value:
    return Value("bool", c)


def field(v: Value, name: str) -> Value:
    if v.kind == "loop":
        if name not in v.held:
            raise unknown(f"loop.{name}")
        return v.held[name]
    if v.kind == "message":
        if name in ("role", "content"):
            return Value("text", v.held[name])
        return Value("variants", v.held[name]) if name == "tool_calls" else UNDEFINED
    if v.kind == "variant":
        return Value("variant", F.try_variant_get(v.held, f"$['{name}']", "variant"))
    if v.kind == "undefined":
        return UNDEFINED
    raise unknown(f"the field {name} of a value of kind {v.kind}")


ONE_OF = {"messages": "message", "variants": "variant", "texts": "text"}


def item(v: Value, at: int) -> Value:
    if v.kind in ONE_OF:
        return Value(ONE_OF[v.kind], F.try_element_at(v.held, F.lit(at if at < 0 else at + 1)))
    raise unknown(f"an index into a value of kind {v.kind}")


def whole(node: ast.expr | None) -> int | None:
    """A whole number written in the template."""
    if node is None:
        return None
    try:
        out = ast.literal_eval(node)
    except ValueError:
        out = None
    if type(out) is not int:
        raise unknown("an index that is no written number")
    return out


def part_of(v: Value, node: ast.Slice) -> Value:
    if v.kind not in ONE_OF or node.step is not None:
        raise unknown("a slice of a value that is no list, or with steps")
    size = F.size(v.held)

    def bound(at: int | None, default: Column) -> Column:
        if at is None:
            return default
        return F.least(F.lit(at), size) if at >= 0 else F.greatest(size + at, F.lit(0))

    low, high = bound(whole(node.lower), F.lit(0)), bound(whole(node.upper), size)
    return Value(v.kind, F.when(v.held.isNotNull(), F.slice(v.held, low + 1, F.greatest(high - low, F.lit(0)))))


def as_text(v: Value) -> Column:
    """Text that rules and comparisons read; null stays null."""
    return F.try_variant_get(v.held, "$", "string") if v.kind == "variant" else v.held if v.kind == "text" else shown(v)


def same(a: Value, b: Value) -> Column:
    for x, y in ((a, b), (b, a)):
        if x.kind in ("none", "undefined"):
            return F.lit(x.kind == y.kind) if y.kind not in ("text", "variant") else is_none(y) if x.kind == "none" else F.lit(False)
    if a.kind == b.kind and a.kind in ("bool", "int"):
        return a.held == b.held
    if {a.kind, b.kind} <= {"text", "variant"}:
        return as_text(a).eqNullSafe(as_text(b))
    if {a.kind, b.kind} <= {"text", "int", "bool"}:
        return F.lit(False)
    raise unknown(f"a comparison of values of kinds {a.kind} and {b.kind}")


def is_none(v: Value) -> Column:
    if v.kind == "text":
        return v.held.isNull()
    if v.kind == "variant":
        return v.held.isNull() | F.is_variant_null(v.held)
    return F.lit(v.kind == "none")


def tested(v: Value, test: str) -> Column:
    if test in ("defined", "undefined"):
        there = v.held.isNotNull() if v.kind in ("variant", "variants", "message") else F.lit(v.kind != "undefined")
        return there if test == "defined" else ~there
    if test in ("none", "None"):
        return is_none(v)
    if test == "string":
        return v.held.isNotNull() if v.kind == "text" else F.schema_of_variant(v.held).eqNullSafe("STRING") if v.kind == "variant" else F.lit(False)
    if test in ("true", "false"):
        return (v.held if test == "true" else ~v.held) if v.kind == "bool" else F.lit(False)
    raise unknown(f"the test {test}")


def compared(op: ast.cmpop, a: Value, right: ast.expr, env: Env) -> Column:
    if isinstance(op, (ast.Is, ast.IsNot)):
        name = right.id if isinstance(right, ast.Name) else "none" if isinstance(right, ast.Constant) and right.value is None else None
        if name is None:
            raise unknown("a test with arguments")
        return tested(a, name) if isinstance(op, ast.Is) else ~tested(a, name)
    b = value_of(right, env)
    if isinstance(op, (ast.Eq, ast.NotEq)):
        return same(a, b) if isinstance(op, ast.Eq) else ~same(a, b)
    if isinstance(op, (ast.In, ast.NotIn)):
        if b.kind == "tuple":
            found = reduce(lambda x, y: x | y, [same(a, x) for x in b.held], F.lit(False))
        elif b.kind in ("text", "variant") and a.kind in ("text", "variant"):
            found = F.coalesce(F.contains(as_text(b), as_text(a)), F.lit(False))
        elif b.kind == "message" and a.kind == "text" and isinstance(right, ast.Name):
            raise unknown("a search for a field's name; write `is defined`")
        else:
            raise unknown(f"a search in a value of kind {b.kind}")
        return found if isinstance(op, ast.In) else ~found
    orders = {ast.Lt: "__lt__", ast.LtE: "__le__", ast.Gt: "__gt__", ast.GtE: "__ge__"}
    if a.kind != "int" or b.kind != "int":
        raise unknown("an order of values that are no numbers")
    return getattr(a.held, orders[type(op)])(b.held)


def chosen(test: Column, a: Value, b: Value) -> Value:
    """One of two values of a kind; of unlike kinds only where both can be written as text."""
    if a.kind == b.kind and a.kind in ("undefined", "none"):
        return a
    if a.kind == b.kind and isinstance(a.held, Column):
        return Value(a.kind, F.when(test, a.held).otherwise(b.held))
    for x, y, own in ((a, b, test), (b, a, ~test)):
        if y.kind in ("none", "undefined") and isinstance(x.held, Column) and x.kind not in ("bool", "int"):
            if x.kind == "text" and y.kind == "undefined":
                return Value("text", F.when(own, x.held).otherwise(""))
            return Value(x.kind, F.when(own, x.held))
    return Value("text", F.when(test, shown(a)).otherwise(shown(b)))


def called(name: str, v: Value, args: list[Value]) -> Value:
    """A filter of ``v`` or a method on it."""
    if name in TEXT_RULES and not args and v.kind in ("text", "variant", "int"):
        return Value("text", TEXT_RULES[name](as_text(v)))
    if name in ("length", "count") and not args and v.kind in ("text", *ONE_OF):
        return Value("int", F.coalesce(F.length(v.held) if v.kind == "text" else F.size(v.held), F.lit(0)))
    if name in ("first", "last") and not args and v.kind in ONE_OF:
        return item(v, 0 if name == "first" else -1)
    if v.kind in ("text", "variant") and len(args) == 1 and args[0].kind == "text":
        if name in ("startswith", "endswith"):
            return truth(F.coalesce(getattr(F, name)(as_text(v), args[0].held), F.lit(False)))
        if name == "split":
            mark = F.concat(F.lit("\\Q"), args[0].held, F.lit("\\E"))
            return Value("texts", F.split(as_text(v), mark, -1))
    if name == "default" and len(args) == 1:
        return args[0] if v.kind == "undefined" else chosen(v.held.isNotNull(), v, args[0]) if v.kind == "variant" else v
    raise unknown(f"{name} with {len(args)} arguments on a value of kind {v.kind}")


def filtered(v: Value, node: ast.expr, env: Env) -> Value:
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Pow):
        return filtered(filtered(v, node.left, env), node.right, env)
    if isinstance(node, ast.Name):
        return called(node.id, v, [])
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and not node.keywords:
        return called(node.func.id, v, [value_of(a, env) for a in node.args])
    raise unknown(f"the filter {ast.unparse(node)}")


def value_of(node: ast.expr, env: Env) -> Value:
    match node:
        case ast.Constant(value=x):
            return constant(x)
        case ast.Name(id="true" | "false" as name):
            return constant(name == "true")
        case ast.Name(id="none"):
            return NONE
        case ast.Name(id=name):
            return env.get(name, UNDEFINED)
        case ast.Attribute(value=base, attr=name):
            return field(value_of(base, env), name)
        case ast.Subscript(value=base, slice=ast.Constant(value=str(name))):
            return field(value_of(base, env), name)
        case ast.Subscript(value=base, slice=ast.Slice() as cut):
            return part_of(value_of(base, env), cut)
        case ast.Subscript(value=base, slice=at):
            return item(value_of(base, env), whole(at))
        case ast.List(elts=parts) | ast.Tuple(elts=parts):
            return Value("tuple", [value_of(p, env) for p in parts])
        case ast.UnaryOp(op=ast.Not(), operand=x):
            return truth(~is_true(value_of(x, env)))
        case ast.UnaryOp(op=ast.USub()):
            return constant(-whole(node.operand))
        case ast.BoolOp(op=op, values=parts):
            out = value_of(parts[0], env)
            for p in parts[1:]:
                other, first = value_of(p, env), is_true(out)
                if out.kind == other.kind == "bool":
                    out = truth(first & other.held if isinstance(op, ast.And) else first | other.held)
                elif out.kind == other.kind:
                    out = chosen(first, other, out) if isinstance(op, ast.And) else chosen(first, out, other)
                else:  # only its truth counts
                    out = truth(first & is_true(other) if isinstance(op, ast.And) else first | is_true(other))
            return out
        case ast.Compare(left=left, ops=ops, comparators=rights):
            out = []
            a = value_of(left, env)
            for op, right in zip(ops, rights, strict=True):
                out.append(compared(op, a, right, env))
                if len(ops) > 1:
                    a = value_of(right, env)
            return truth(reduce(lambda x, y: x & y, out))
        case ast.IfExp(test=test, body=a, orelse=b):
            return chosen(is_true(value_of(test, env)), value_of(a, env), value_of(b, env))
        case ast.BinOp(left=left, op=ast.Pow(), right=rule):
            return filtered(value_of(left, env), rule, env)
        case ast.BinOp(left=left, op=ast.Add(), right=right):
            a, b = value_of(left, env), value_of(right, env)
            return Value("int", a.held + b.held) if a.kind == b.kind == "int" else Value("text", F.concat(shown(a), shown(b)))
        case ast.BinOp(left=left, op=ast.Sub() | ast.Mod() as op, right=right):
            a, b = value_of(left, env), value_of(right, env)
            if a.kind == b.kind == "int":
                return Value("int", a.held - b.held if isinstance(op, ast.Sub) else F.pmod(a.held, b.held))
        case ast.Call(func=ast.Name(id="raise_exception"), args=[said]):
            return Value("refused", env["raise_exception"].held(shown(value_of(said, env))))
        case ast.Call(func=ast.Attribute(value=base, attr=name), args=args, keywords=[]):
            return called(name, value_of(base, env), [value_of(a, env) for a in args])
    raise unknown(ast.unparse(node))


def parsed(text: str) -> ast.expr:
    """An expression; ``|`` binds closest in templates, as ``**`` does in Python, ``~``
    joins like ``+``, and quoted text may go over lines."""
    python = OPERATOR.sub(lambda m: m[1].replace("\n", "\\n") if m[1] else {"|": "**", "~": "+"}[m[0]], text.strip())
    try:
        return ast.parse(f"({python})", mode="eval").body
    except SyntaxError as e:
        raise unknown(text.strip()) from e


def pieces_of(source: str) -> list[tuple[str, str]]:
    """(kind, text) of plain text, blocks and values. The line end after a block and the
    blanks before one that begins its line are left out, as tokenizers do."""
    out, at, cut_left, line_cut = [], 0, False, False
    source = source[:-1] if source.endswith("\n") else source

    def plain(text: str, end_cut: bool, block_next: bool, first: bool) -> None:
        if block_next and not end_cut:
            text = re.sub(r"(^|\n)[ \t]*\Z" if first else r"(\n)[ \t]*\Z", r"\1", text)
        if line_cut and text.startswith("\n"):
            text = text[1:]
        text = text.lstrip() if cut_left else text
        text = text.rstrip() if end_cut else text
        if text:
            out.append(("text", text))

    for m in TAG.finditer(source):
        kind = "block" if m["block"] is not None else "value" if m["value"] is not None else "note"
        left, right = (m["l1"], m["r1"]) if kind == "block" else (m["l2"], m["r2"]) if kind == "value" else (m["l3"], m["r3"])
        plain(source[at:m.start()], left == "-", kind != "value" and left != "+", at == 0)
        if kind != "note":
            out.append((kind, m[kind].strip()))
        at, cut_left, line_cut = m.end(), right == "-", kind != "value"
    plain(source[at:], False, False, at == 0)
    return out


class Reader:
    """Blocks of a template in order, rendered to (texts, variables, whether it can refuse)."""

    def __init__(self, source: str):
        self.pieces, self.at = pieces_of(source), 0
        self.refuses = "raise_exception" in source

    def body(self, env: Env, *ends: str) -> tuple[list[Column], Env, str]:
        """Up to one of the block words ``ends``, which is returned with its expression."""
        out, env = [], dict(env)
        while self.at < len(self.pieces):
            kind, text = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                out.append(F.lit(text))
            elif kind == "value":
                out.append(shown(value_of(parsed(text), env)))
            elif (word := text.split(None, 1)[0] if text else "") in ends:
                return out, env, text
            elif word == "set" and (m := re.fullmatch(r"set\s+(\w+)\s*=(?!=)(.*)", text, re.DOTALL)):
                env[m[1]] = value_of(parsed(m[2]), env)
            elif word == "if":
                made, env = self.branch(text[2:], env)
                out.append(made)
            elif word == "for" and (m := re.fullmatch(r"for\s+(\w+)\s+in\s+(.*)", text, re.DOTALL)):
                out.append(self.loop(m[1], m[2], env))
            else:
                raise unknown(f"{{% {text} %}}")
        if ends:
            raise ValueError(f"the template ends before {ends[-1]}")
        return out, env, ""

    def branch(self, test: str, env: Env) -> tuple[Column, Env]:
        holds = is_true(value_of(parsed(test), env))
        texts, then, end = self.body(env, "elif", "else", "endif")
        other, otherwise = [F.lit("")], env
        if end.startswith("elif"):
            made, otherwise = self.branch(end[4:], env)
            other = [made]
        elif end == "else":
            other, otherwise, _ = self.body(env, "endif")
        names = {n for n in then | otherwise if then.get(n) is not otherwise.get(n)}
        merged = {n: chosen(holds, then.get(n, UNDEFINED), otherwise.get(n, UNDEFINED)) for n in names}
        return F.when(holds, joined(texts)).otherwise(joined(other)), env | merged

    def loop(self, name: str, over: str, env: Env) -> Column:
        rows, start = value_of(parsed(over), env), self.at
        if rows.kind == "variant":
            rows = Value("variants", F.try_variant_get(rows.held, "$", "array<variant>"))
        if rows.kind not in ONE_OF:
            raise unknown(f"a loop over a value of kind {rows.kind}")
        size = F.size(rows.held)

        def turn(one: Column, i: Column) -> Column:
            self.at = start
            place = {"index0": Value("int", i), "index": Value("int", i + 1), "length": Value("int", size),
                     "first": truth(i == 0), "last": truth(i == size - 1)}
            texts, _, _ = self.body(env | {name: Value(ONE_OF[rows.kind], one), "loop": Value("loop", place)}, "endfor")
            return joined(texts)

        made = F.transform(F.coalesce(rows.held, F.array().cast(LISTS[rows.kind])) if rows.kind != "messages" else rows.held, turn)
        if not self.refuses:
            return F.array_join(made, "")
        # Looked at and joined under one name, so that it is made once.
        return F.transform(F.array(made), lambda ts: F.when(F.forall(ts, lambda t: t.isNotNull()), F.array_join(ts, "")))[0]


LISTS = {"variants": "array<variant>", "texts": "array<string>"}


def joined(texts: list[Column]) -> Column:
    return texts[0] if len(texts) == 1 else F.concat(*texts) if texts else F.lit("")


def compile_template(
    source: str, *, add_generation_prompt: bool = False, strict: bool = False, **names: str | bool | int | None,
) -> Callable[[Column, Column], Column]:
    """A chat template as a function of the columns ``messages`` and ``tools``.

    ``names`` are further variables, such as ``bos_token``. Null messages give a null
    text, an empty list what the template writes without any. Null roles equal
    nothing, null contents are written as ``None``. A conversation that the template
    refuses by ``raise_exception`` gets a null text, with ``strict`` it fails the job.
    """

    def refuse(said: Column) -> Column:
        return F.raise_error(F.concat(F.lit("conversation refused: "), said)).cast("string") if strict else F.lit(None).cast("string")

    def render(messages: Column, tools: Column) -> Column:
        env = {k: constant(v) for k, v in names.items()} | {
            "messages": Value("messages", messages), "tools": Value("variant", tools),
            "add_generation_prompt": constant(add_generation_prompt), "raise_exception": Value("function", refuse)}
        texts, _, _ = Reader(source).body(env)
        return F.when(messages.isNotNull(), joined(texts))

    return render
