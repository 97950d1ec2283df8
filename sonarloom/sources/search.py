"""A search body (JSON) compiled to a filter, an order and a limit, so that the Parquet scan can push them down.

Supported: bool (must, filter, should, must_not), simple_query_string (+ | - "phrase" prefix* and brackets), match, term,
terms, range (with a day-based format), exists, sort, size, _source. Words match whole tokens, letter case aside."""

from __future__ import annotations

import json
import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonarloom.functions import text as T

DEFAULT_SIZE = 30
TOKEN = re.compile(r'"([^"]*)"|([()+|-])|([^\s()"|+]+)')


def _term(field: str, word: str) -> Column:
    tokens = T.words(field)
    word = word.lower()
    if word.endswith("*"):
        return F.exists(tokens, lambda t: t.startswith(word[:-1]))
    parts = re.findall(r"\w+", word)
    return _phrase(field, parts) if len(parts) != 1 else F.array_contains(tokens, parts[0])


def _phrase(field: str, parts: list[str]) -> Column:
    if not parts:
        return F.lit(True)
    return F.concat(F.lit(" "), F.array_join(T.words(field), " "), F.lit(" ")).contains(f" {' '.join(parts)} ")


def simple_query(query: str, fields: list[str], default: str = "or") -> Column:
    """``+`` joins by AND, ``|`` by OR, ``-`` negates; words side by side are joined by the default operator."""
    tokens = [m.groups() for m in TOKEN.finditer(query)]
    at = 0

    def over(f) -> Column:
        return reduce(lambda a, b: a | b, (f(c) for c in fields))

    def atom() -> Column | None:
        nonlocal at
        if at >= len(tokens):
            return None
        phrase, mark, word = tokens[at]
        at += 1
        if phrase is not None:
            return over(lambda c: _phrase(c, re.findall(r"\w+", phrase.lower())))
        if mark == "-":
            inner = atom()
            return None if inner is None else ~inner
        if mark == "(":
            inner = either(True)
            return inner
        if mark:
            return atom()
        if word.startswith("-") and len(word) > 1:
            return ~over(lambda c: _term(c, word[1:]))
        return over(lambda c: _term(c, word))

    def either(inside: bool = False) -> Column | None:
        nonlocal at
        out, join = None, default
        while at < len(tokens):
            mark = tokens[at][1]
            if mark == ")":
                at += 1
                if inside:
                    break
                continue
            if mark in ("+", "|"):
                join = "and" if mark == "+" else "or"
                at += 1
                continue
            new = atom()
            if new is not None:
                out = new if out is None else (out & new if join == "and" else out | new)
            join = default
        return out

    found = either()
    return F.lit(True) if found is None else found


FORMATS = {"dd-MM-yyyy": "day", "yyyy-MM-dd": "day"}


def _range(field: str, spec: dict) -> Column:
    fmt, out, c = spec.get("format"), F.lit(True), F.col(field)
    day = FORMATS.get(fmt)
    bound = (lambda v: F.to_date(F.lit(v), fmt)) if day else F.lit
    for op, v in spec.items():
        if op in ("gte", "from"):
            out = out & (c >= bound(v))
        elif op in ("lte", "to"):
            # A day's end belongs to it.
            out = out & ((c < F.date_add(bound(v), 1)) if day else (c <= bound(v)))
        elif op == "gt":
            out = out & ((c >= F.date_add(bound(v), 1)) if day else (c > bound(v)))
        elif op == "lt":
            out = out & (c < bound(v))
    return out


def compile_query(q: dict) -> Column:
    (kind, body), *rest = q.items()
    if rest:
        return reduce(lambda a, b: a & b, (compile_query({k: v}) for k, v in q.items()))
    each = lambda x: [compile_query(i) for i in (x if isinstance(x, list) else [x])]
    if kind == "bool":
        out = F.lit(True)
        for part in ("must", "filter"):
            for c in each(body.get(part, [])):
                out = out & c
        for c in each(body.get("must_not", [])):
            out = out & ~c
        should = each(body.get("should", []))
        if should and (body.get("minimum_should_match") or not (body.get("must") or body.get("filter"))):
            out = out & reduce(lambda a, b: a | b, should)
        return out
    if kind in ("simple_query_string", "query_string"):
        return simple_query(body["query"], body.get("fields") or [body.get("default_field", "content")], body.get("default_operator", "or").lower())
    if kind == "match_all":
        return F.lit(True)
    if kind == "exists":
        return F.col(body["field"]).isNotNull()
    (field, value), *_ = body.items()
    if kind == "range":
        return _range(field, value)
    if kind == "match":
        return simple_query(value["query"] if isinstance(value, dict) else str(value), [field])
    if kind == "terms":
        return F.col(field).isin(value)
    if kind == "term":
        return F.col(field) == F.lit(value["value"] if isinstance(value, dict) else value)
    raise ValueError(f"unknown clause: {kind}")


def query_terms(q: dict) -> list[tuple[str, str]]:
    """(word, field) of the positive words of a query's full-text clauses, in order, each once."""
    found: list[tuple[str, str]] = []
    for kind, body in q.items():
        if kind == "bool":
            for part in ("must", "filter", "should"):
                some = body.get(part, [])
                for clause in some if isinstance(some, list) else [some]:
                    found += query_terms(clause)
        elif kind in ("simple_query_string", "query_string"):
            words = re.findall(r"[^\W]+", re.sub(r"(^|\s)-\S+", " ", body["query"].lower()))
            found += [(w, f) for w in words for f in body.get("fields") or [body.get("default_field", "content")]]
        elif kind == "match":
            for field, value in body.items():
                found += [(w, field) for w in re.findall(r"[^\W]+", str(value["query"] if isinstance(value, dict) else value).lower())]
    return list(dict.fromkeys(found))


def search(posts: DataFrame, body: str | dict, tie: str = "_id", size: int | None = None) -> DataFrame:
    """Rows that match, in the body's order (ties by id), at most ``size`` of them (0: all)."""
    body = json.loads(body) if isinstance(body, str) else body
    out = posts.where(compile_query(body.get("query", {"match_all": {}})))
    order = []
    for s in body.get("sort", []):
        (field, way), *_ = s.items() if isinstance(s, dict) else [(s, "asc")]
        way = way["order"] if isinstance(way, dict) else way
        order.append(F.desc(field) if way == "desc" else F.asc(field))
    if not order and (terms := query_terms(body.get("query", {}))):
        # Without a sort, by relevance: how often the terms stand in a row, rarer terms (among all rows) more.
        tokens = {f: T.words(f) for _, f in terms}
        seen = posts.agg(F.count("*").alias("n"), *[F.count_if(F.array_contains(tokens[f], t)).alias(f"t{k}") for k, (t, f) in enumerate(terms)]).first()
        weights = [math.log(1 + (seen["n"] - seen[f"t{k}"] + 0.5) / (seen[f"t{k}"] + 0.5)) for k in range(len(terms))]
        score = F.lit(0.0)
        for (t, f), w in zip(terms, weights):
            n = F.size(tokens[f]) - F.size(F.array_remove(tokens[f], t))
            score = score + F.lit(w) * n / (n + 1.2)
        order = [F.desc(F.round(score, 9))]
    out = out.orderBy(*order, F.asc(tie))
    n = body.get("size", DEFAULT_SIZE) if size is None else size
    out = out.limit(n) if n else out
    return out.select(*body["_source"]) if body.get("_source") else out
