"""Phrases of many rules found in one pass over a text, and rules that weigh them by position and section.

A phrase is written in a small notation: words in a row, `a|b` for either word, `[a|b]` for one of them or none, `...` for a gap of
at most GAP characters inside one line, and `x*` for a word that begins with x (last word of a part only). All plain
forms of all parts of all rules are in one Aho-Corasick automaton. It runs once over the normal form of a text, so the cost is
linear in the text and its hits; gaps, windows, captures and sections are comparisons of positions.

The normal form has lower-case words between single spaces, ` . ` at the end of a sentence, ` | ` at the end of a line, and
headings between ` §h ` and ` §e `. It is made by replacements in the JVM, which DuckDB has as well.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left, bisect_right
from collections import defaultdict
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

GAP, CAPTURE = 80, 160
#: (pattern, replacement) in order; group references are written \1 here
PAGE_STEPS = (
    (r"[|§\s]+", " "), (r"(?i)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " "), (r"(?i)&nbsp;", " "), (r"(?i)&#39;|&rsquo;|&apos;", "'"), (r"(?i)&amp;", "&"),
    (r"(?i)<h[1-6][^>]*>(.*?)</h[1-6]>", "\n§h \\1 §e\n"), (r"(?i)<(?:b|strong)>([^<]{3,60})</(?:b|strong)>:? ?(?:<br|</p|</div)[^>]*>", "\n§h \\1 §e\n"),
    (r"(?i)</?(?:p|div|li|ul|ol|br|tr|td|table|section|article|title)\b[^>]*>", "\n"), (r"<[^>]*>", " "),
)
PLAIN_STEPS = ((r"[|§]", " "), (r"(?m)^[ \t]*([A-Z][^\n.:]{2,60}):[ \t]*$", "§h \\1 §e"))
NORMAL_STEPS = (
    (r"['’]", ""), (r"\bph\.? ?d\b\.?", "phd"), (r"\b([a-z])\.([a-z])\b\.?", "\\1\\2"), (r"[.!?;]+(\s|$)", " . \\1"), (r"\n", " | "), (r"[^a-z0-9|.§]+", " "),
)


def _steps(text: Column, steps: tuple[tuple[str, str], ...]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by.replace("\\1", "$1").replace("\\2", "$2"))
    return text


def _words(text: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(_steps(F.lower(text), NORMAL_STEPS)), F.lit(" "))


def plain_words(text: Column) -> Column:
    """The normal form of a plain text; lines that end in a colon are headings. Null as empty."""
    return _words(_steps(F.coalesce(text, F.lit("")), PLAIN_STEPS))


def page_words(html: Column) -> Column:
    """The normal form of a page; its headings are h1 to h6 and bold lines."""
    return _words(_steps(F.coalesce(html, F.lit("")), PAGE_STEPS))


def sql_words(c: str, steps: tuple[tuple[str, str], ...] = PLAIN_STEPS) -> str:
    """plain_words() in SQL."""
    def apply(x: str, steps: tuple[tuple[str, str], ...]) -> str:
        for pattern, by in steps:
            quoted = [v.replace("'", "''").replace("\n", "' || chr(10) || '") for v in (pattern, by)]
            x = f"regexp_replace({x}, '{quoted[0]}', '{quoted[1]}', 'g')"
        return x

    return f"' ' || trim({apply('lower(' + apply(f'coalesce({c}, {chr(39) * 2})', steps) + ')', NORMAL_STEPS)}) || ' '"


def plain_forms(part: str) -> list[str]:
    """All word rows that a part without gaps stands for."""
    choices = [[*x[1:-1].split("|"), ""] if x[0] == "[" else x.split("|") for x in part.split()]
    return [" ".join(filter(None, row)) for row in itertools.product(*choices)]


class Rule(NamedTuple):
    """reason, if a phrase stands in the text without rescue.

    rescue: phrases that save a hit within `window` characters of it, or anywhere if window is 0. within: kinds of sections in which a
    rescuing phrase saves any hit. outside: kinds of sections in which hits don't count. fields: if given, a hit counts only if
    the sentence after it has a field, and is saved by a rescuing phrase in that sentence only.
    """

    reason: str
    phrases: tuple[str, ...]
    rescue: tuple[str, ...] = ()
    window: int = 0
    within: tuple[str, ...] = ()
    outside: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()


class Section(NamedTuple):
    kind: str
    start: int
    end: int


#: words of headings by kind of section, first kind first
SECTIONS = (
    ("preferred", ("preferred", "nice to have", "bonus", "plus", "desired")),
    ("requirements", ("requirement", "qualification", "what you need", "who you are", "must have", "you have", "eligibility", "what we are looking for", "your profile", "skills")),
    ("duties", ("responsibilit", "what you will do", "what youll do", "duties", "the role", "day to day")),
    ("about", ("about", "who we are", "our team", "our story", "our mission", "company")),
    ("benefits", ("benefit", "perks", "what we offer", "compensation", "salary")),
)


def sections(text: str) -> list[Section]:
    """Headed ranges of a normal form; the text before the first heading is of kind 'top', unknown headings head 'other'."""
    found, at, kind = [], 0, "top"
    while True:
        mark = text.find(" §h ", at)
        found.append(Section(kind, at, len(text) if mark < 0 else mark))
        if mark < 0:
            return found
        close = text.find(" §e ", mark)
        head = text[mark + 4 : close if close >= 0 else len(text)]
        kind = next((k for k, words in SECTIONS if any(f" {w}" in f" {head}" for w in words)), "other")
        at = close + 3 if close >= 0 else len(text)


class Hit(NamedTuple):
    rule: int
    start: int
    end: int
    rescued: bool


class Matcher:
    def __init__(self, rules: tuple[Rule, ...]):
        from ahocorasick import Automaton

        self.rules, self.automaton = rules, Automaton()
        #: parts of all rules: (rule, role, phrase, number of the part, parts of the phrase)
        self.parts = [(r, role, p, i, phrase.count(" ... ") + 1) for r, role, p, phrase in _phrases(rules) for i in range(phrase.count(" ... ") + 1)]
        forms = defaultdict(list)
        for number, form in enumerate(part for _, _, _, phrase in _phrases(rules) for part in phrase.split(" ... ")):
            for row in plain_forms(form):
                forms[" " + row[:-1] if row.endswith("*") else f" {row} "].append(number)
        for row, numbers in forms.items():
            self.automaton.add_word(row, (len(row), tuple(numbers)))
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[Hit]:
        """All hits of all rules, by rule and position."""
        spans: dict[tuple, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for last, (size, numbers) in self.automaton.iter(text):
            start = last - size + 2
            end = last if text[last] == " " else _end_of_word(text, last + 1)
            for number in numbers:
                rule, role, phrase, i, n = self.parts[number]
                spans[rule, role, phrase, n][i].append((start, end))
        whole: dict[tuple, set[tuple[int, int]]] = defaultdict(set)
        for (rule, role, _, n), parts in spans.items():
            if len(parts) == n:
                whole[rule, role].update(_with_gaps([parts[i] for i in range(n)], text))
        if not any(role == "phrase" for _, role in whole):
            return []
        ranges, found = None, []
        for r, rule in enumerate(self.rules):
            own = sorted(whole.get((r, "phrase"), ()))
            if not own:
                continue
            rescue, fields = sorted(whole.get((r, "rescue"), ())), sorted(whole.get((r, "field"), ()))
            if (rule.within or rule.outside) and ranges is None:
                ranges = sections(text)
            saved = bool(rescue) and any(s.kind in rule.within and _inside(rescue, s.start, s.end) for s in ranges or ())
            for start, end in own:
                if rule.outside and any(s.kind in rule.outside and s.start <= start < s.end for s in ranges):
                    continue
                if rule.fields:
                    stop = min([x for x in (text.find(" . ", end), text.find(" | ", end), end + CAPTURE) if x >= 0])
                    if _inside(fields, end, stop):
                        found.append(Hit(r, start, end, _inside(rescue, end, stop)))
                    continue
                near = bool(rescue) if not rule.window else _inside(rescue, start - rule.window, end + rule.window)
                found.append(Hit(r, start, end, saved or near))
        return found

    def reason(self, text: str) -> str | None:
        return next((self.rules[h.rule].reason for h in self.hits(text) if not h.rescued), None)


def _phrases(rules: tuple[Rule, ...]) -> list[tuple[int, str, int, str]]:
    """(rule, role, number, phrase) of all phrases."""
    return [(r, role, p, phrase) for r, rule in enumerate(rules) for role, phrases in (("phrase", rule.phrases), ("rescue", rule.rescue), ("field", rule.fields)) for p, phrase in enumerate(phrases)]


def _end_of_word(text: str, at: int) -> int:
    end = text.find(" ", at)
    return len(text) if end < 0 else end


def _inside(spans: list[tuple[int, int]], low: int, high: int) -> bool:
    """Whether one of the sorted spans lies in low..high."""
    for start, end in itertools.islice(spans, bisect_left(spans, (low, -1)), None):
        if start > high:
            return False
        if end <= high:
            return True
    return False


def _with_gaps(parts: list[list[tuple[int, int]]], text: str) -> set[tuple[int, int]]:
    """Spans of the parts in their order, at most GAP characters apart and with no end of a line between."""
    whole = set(parts[0])
    for part in parts[1:]:
        part = sorted(part)
        starts, longer = [s for s, _ in part], set()
        for start, end in whole:
            line = text.find(" | ", end - 1)
            high = min(end + GAP, line if line >= 0 else len(text))
            longer.update((start, part[i][1]) for i in range(bisect_left(starts, end), bisect_right(starts, high)))
        whole = longer
    return whole


@cache
def matcher(rules: tuple[Rule, ...]) -> Matcher:
    """One per worker process and set of rules."""
    return Matcher(rules)


def first_reason(words: Column, rules: tuple[Rule, ...]) -> Column:
    """The reason of the first rule with a hit that nothing saves, of a text in normal form."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        find = matcher(rules).reason
        return texts.map(find)

    return run(words)


def all_hits(words: Column, rules: tuple[Rule, ...]) -> Column:
    """array of (reason, start, end, rescued): every hit, by rule and position in the normal form."""
    @F.pandas_udf("array<struct<reason: string, start: int, end: int, rescued: boolean>>")
    def run(texts: pd.Series) -> pd.Series:
        find = matcher(rules).hits
        return texts.map(lambda t: [{"reason": rules[h.rule].reason, "start": h.start, "end": h.end, "rescued": h.rescued} for h in find(t)])

    return run(words)


def sql_hits(text: str, rules: tuple[Rule, ...]) -> str:
    """SQL views over `words(id, t)`, a table of normal forms: hit(id, rule, s, e, rescued). Rules have no sections and two parts at most."""
    forms = [(r, role, p, i, phrase.count(" ... ") + 1, row) for r, role, p, phrase in _phrases(rules) for i, part in enumerate(phrase.split(" ... ")) for row in plain_forms(part)]
    values = ", ".join(f"({r},'{role}',{p},{i},{n},'{row}')" for r, role, p, i, n, row in forms)
    windows = ", ".join(f"({r}, {rule.window}, {bool(rule.fields)})" for r, rule in enumerate(rules))
    return f"""words AS ({text}), form(rule, role, p, i, n, f) AS (VALUES {values}), rules(rule, w, captures) AS (VALUES {windows}),
row_form AS (SELECT *, string_split(f, ' ') AS fw FROM form),
token AS (SELECT id, t, tw, k, tw[k] AS word, len(array_to_string(tw[1 : k - 1], ' ')) + CASE WHEN k > 1 THEN 1 ELSE 0 END + 1 AS pos FROM (SELECT id, t, tw, unnest(range(1, len(tw) + 1)) AS k FROM (SELECT id, t, string_split(trim(t), ' ') AS tw FROM words))),
near AS (SELECT token.*, row_form.* FROM token JOIN row_form ON word = fw[1] UNION ALL SELECT token.*, row_form.* FROM token, row_form WHERE ends_with(fw[1], '*') AND starts_with(word, rtrim(fw[1], '*'))),
part AS (SELECT DISTINCT id, t, rule, role, p, i, n, pos AS s, pos + len(array_to_string(tw[k : k + len(fw) - 1], ' ')) AS e FROM near
    WHERE CASE WHEN ends_with(f, '*') THEN tw[k : k + len(fw) - 2] = fw[1 : len(fw) - 1] AND starts_with(tw[k + len(fw) - 1], rtrim(fw[len(fw)], '*')) ELSE tw[k : k + len(fw) - 1] = fw END),
span AS (SELECT DISTINCT id, t, rule, role, s, e FROM part WHERE n = 1 UNION SELECT a.id, a.t, a.rule, a.role, a.s, b.e FROM part a JOIN part b ON a.id = b.id AND a.rule = b.rule AND a.role = b.role AND a.p = b.p
    WHERE a.n = 2 AND a.i = 0 AND b.i = 1 AND b.s >= a.e AND b.s <= a.e + {GAP} AND NOT contains(substr(a.t, a.e + 1, b.s - a.e), ' | ')),
own AS (SELECT s.*, w, captures, least(coalesce(nullif(instr(substr(t, e + 1), ' . '), 0) - 1 + e, 1000000000), coalesce(nullif(instr(substr(t, e + 1), ' | '), 0) - 1 + e, 1000000000), e + {CAPTURE}) AS stop FROM span s JOIN rules USING (rule) WHERE role = 'phrase'),
hit AS (SELECT id, rule, s, e, EXISTS (SELECT 1 FROM span x WHERE x.id = o.id AND x.rule = o.rule AND x.role = 'rescue' AND CASE WHEN captures THEN x.s >= o.e AND x.e <= stop WHEN w = 0 THEN true ELSE x.s >= o.s - w AND x.e <= o.e + w END) AS rescued
    FROM own o WHERE NOT captures OR EXISTS (SELECT 1 FROM span x WHERE x.id = o.id AND x.rule = o.rule AND x.role = 'field' AND x.s >= o.e AND x.e <= stop))"""
