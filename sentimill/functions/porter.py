"""Porter (1980) stemmer as one SQL expression, with the NLTK default-mode refinements.

Design
------
Every condition of the algorithm is a test on the consonant/vowel pattern of a stem
("m", the number of VC pairs; "*v*"; "*d"; "*o"). The pattern of a word is computed once
per step with literal string functions only (no regex): letters are translated to ``V`` /
``C``, then each ``y`` takes the class opposite to the letter before it. The pattern of a
stem is a prefix of the pattern of the word, so every rule reads a ``left(...)`` of it.

Each step is a ``CASE`` whose first matching suffix decides (a failed condition leaves
the word unchanged, as in the published algorithm). Steps are chained with a let-binding
(``Dialect.let``) so each intermediate word is evaluated once and the expression grows
linearly with the number of steps.

The expression is plain Spark SQL / DuckDB SQL: inside Spark it runs per token in the
executors, with no shuffle and no Python. ``word_stemmer`` applies the same steps to one
Python string; ``text.stem_each`` uses it for whole token lists.
"""

from __future__ import annotations

from .sqlgen import Dialect, ascii_lower

# --- FIXED VALUES: irregular forms of the NLTK default mode (word -> stem) ---
IRREGULAR_FORMS: list[tuple[str, str]] = [
    ("sky", "sky"), ("skies", "sky"),
    ("dying", "die"), ("lying", "lie"), ("tying", "tie"),
    ("news", "news"),
    ("innings", "inning"), ("inning", "inning"),
    ("outings", "outing"), ("outing", "outing"),
    ("cannings", "canning"), ("canning", "canning"),
    ("howe", "howe"),
    ("proceed", "proceed"), ("exceed", "exceed"), ("succeed", "succeed"),
]

_LETTERS = "abcdefghijklmnopqrstuvwxz0123456789"  # every letter but y, and digits
_CLASSES = "".join("V" if ch in "aeiou" else "C" for ch in _LETTERS)


class _Step:
    """Expression builder for one step over word ``w`` with pattern ``c``."""

    def __init__(self, d: Dialect, w: str, c: str):
        self.d, self.w, self.c = d, w, c

    def ends(self, suffix: str) -> str:
        return self.d.ends_with(self.w, suffix)

    def stem(self, k: int) -> str:  # word without its last k letters
        return f"left({self.w}, length({self.w}) - {k})"

    def pat(self, k: int) -> str:  # pattern of that stem
        return f"left({self.c}, length({self.c}) - {k})"

    def swap(self, k: int, repl: str) -> str:
        return f"concat({self.stem(k)}, {self.d.lit(repl)})" if repl else self.stem(k)

    # conditions on a pattern expression p (m = number of 'VC' in p)
    @staticmethod
    def m_gt0(p: str) -> str:
        return f"instr({p}, 'VC') > 0"

    @staticmethod
    def m_gt1(p: str) -> str:
        return f"length({p}) - length(replace({p}, 'VC', '')) > 2"

    @staticmethod
    def m_eq1(p: str) -> str:
        return f"length({p}) - length(replace({p}, 'VC', '')) = 2"

    @staticmethod
    def has_vowel(p: str) -> str:
        return f"instr({p}, 'V') > 0"

    def cvc(self, s: str, p: str) -> str:
        """*o: stem ends consonant-vowel-consonant, last not w/x/y; or is a 2-letter VC."""
        return (f"((length({p}) >= 3 AND right({p}, 3) = 'CVC' "
                f"AND right({s}, 1) NOT IN ('w', 'x', 'y')) OR {p} = 'VC')")

    def rules(self, table) -> str:
        """First rule whose suffix matches decides; a failed condition keeps the word."""
        parts = []
        for suffix, repl, cond in table:
            k = len(suffix)
            test = cond(self.pat(k), k)
            parts.append(f"WHEN {self.ends(suffix)} THEN "
                         f"CASE WHEN {test} THEN {self.swap(k, repl)} ELSE {self.w} END")
        return f"CASE {' '.join(parts)} ELSE {self.w} END"


def _letters(d: Dialect, w: str) -> str:
    """'V' / 'C' per letter of ``w``; a y after the first letter stays open."""
    def classes(x: str) -> str:
        return f"translate({x}, {d.lit(_LETTERS)}, {d.lit(_CLASSES)})"
    return f"CASE WHEN left({w}, 1) = 'y' THEN concat('C', {classes(f'substr({w}, 2)')}) ELSE {classes(w)} END"


def _pattern(d: Dialect, letters: str) -> str:
    """Consonant/vowel pattern: y after a consonant is a vowel and vice versa."""
    p = letters
    if d.name == "spark":  # the classes of a longer run alternate: by pairs from its start on
        for x, pair in (("C", "VC"), ("V", "CV")):
            p = d.replace_all(p, f"(?:(?<={x})|(?!^)\\G)yy", pair)
        p = f"CASE WHEN instr({letters}, 'yyy') > 0 THEN {p} ELSE {letters} END"
    for _ in range(2):
        p = f"replace(replace({p}, 'Cy', 'CV'), 'Vy', 'VC')"
    return p


def _step1a(s: _Step) -> str:
    w = s.w
    return (f"CASE WHEN {s.ends('ies')} AND length({w}) = 4 THEN {s.swap(3, 'ie')} "
            f"WHEN {s.ends('sses')} THEN {s.swap(4, 'ss')} "
            f"WHEN {s.ends('ies')} THEN {s.swap(3, 'i')} "
            f"WHEN {s.ends('ss')} THEN {w} "
            f"WHEN {s.ends('s')} THEN {s.stem(1)} ELSE {w} END")


def _step1b_tail(d: Dialect, v: str, cv: str) -> str:
    """Rules applied to the stem left after removing -ed / -ing."""
    t = _Step(d, v, cv)
    double = (f"length({v}) >= 2 AND right({v}, 1) = left(right({v}, 2), 1) "
              f"AND right({cv}, 1) = 'C'")
    return (f"CASE WHEN {t.ends('at')} OR {t.ends('bl')} OR {t.ends('iz')} THEN concat({v}, 'e') "
            f"WHEN {double} THEN CASE WHEN right({v}, 1) IN ('l', 's', 'z') THEN {v} "
            f"ELSE left({v}, length({v}) - 1) END "
            f"WHEN {_Step.m_eq1(cv)} AND {t.cvc(v, cv)} THEN concat({v}, 'e') "
            f"ELSE {v} END")


def _step1b(s: _Step, ed: str, ing: str) -> str:
    """``ed`` / ``ing`` name the word without -ed / -ing (bound by the caller)."""
    d, w = s.d, s.w
    tail_ed = _step1b_tail(d, ed, f"left({s.c}, length({ed}))")
    tail_ing = _step1b_tail(d, ing, f"left({s.c}, length({ing}))")
    return (f"CASE WHEN {s.ends('ied')} THEN "
            f"CASE WHEN length({w}) = 4 THEN {s.swap(3, 'ie')} ELSE {s.swap(3, 'i')} END "
            f"WHEN {s.ends('eed')} THEN "
            f"CASE WHEN {_Step.m_gt0(s.pat(3))} THEN {s.swap(3, 'ee')} ELSE {w} END "
            f"WHEN {s.ends('ed')} AND {_Step.has_vowel(s.pat(2))} THEN {tail_ed} "
            f"WHEN {s.ends('ing')} AND {_Step.has_vowel(s.pat(3))} THEN {tail_ing} "
            f"ELSE {w} END")


def _step1c(s: _Step) -> str:
    # y -> i when the letter before it is a consonant and the stem is longer than 1
    return (f"CASE WHEN {s.ends('y')} AND length({s.w}) > 2 "
            f"AND substr({s.c}, length({s.c}) - 1, 1) = 'C' "
            f"THEN {s.swap(1, 'i')} ELSE {s.w} END")


def _gt0(p, k):
    return _Step.m_gt0(p)


def _gt1(p, k):
    return _Step.m_gt1(p)


_STEP2 = [
    ("ational", "ate", _gt0), ("tional", "tion", _gt0), ("enci", "ence", _gt0),
    ("anci", "ance", _gt0), ("izer", "ize", _gt0), ("bli", "ble", _gt0),
    ("alli", "al", _gt0), ("entli", "ent", _gt0), ("eli", "e", _gt0),
    ("ousli", "ous", _gt0), ("ization", "ize", _gt0), ("ation", "ate", _gt0),
    ("ator", "ate", _gt0), ("alism", "al", _gt0), ("iveness", "ive", _gt0),
    ("fulness", "ful", _gt0), ("ousness", "ous", _gt0), ("aliti", "al", _gt0),
    ("iviti", "ive", _gt0), ("biliti", "ble", _gt0), ("fulli", "ful", _gt0),
]

_STEP3 = [
    ("icate", "ic", _gt0), ("ative", "", _gt0), ("alize", "al", _gt0),
    ("iciti", "ic", _gt0), ("ical", "ic", _gt0), ("ful", "", _gt0), ("ness", "", _gt0),
]


def _step2(s: _Step) -> str:
    # the 'l' of -logi stays with the stem for the measure test
    logi = ("logi", "log", lambda p, k: _Step.m_gt0(f"left({s.c}, length({s.c}) - 3)"))
    return s.rules(_STEP2 + [logi])


def _step2_alli(s: _Step) -> str:
    # -alli becomes -al first, and the result goes through the other rules of step 2
    return s.rules([("alli", "al", _gt0)])


def _step4(s: _Step) -> str:
    ion = ("ion", "", lambda p, k: f"{_Step.m_gt1(p)} AND right({s.stem(3)}, 1) IN ('s', 't')")
    table = [(x, "", _gt1) for x in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant",
                                      "ement", "ment", "ent")]
    table.append(ion)
    table += [(x, "", _gt1) for x in ("ou", "ism", "ate", "iti", "ous", "ive", "ize")]
    return s.rules(table)


def _step5a(s: _Step) -> str:
    p = s.pat(1)
    return (f"CASE WHEN {s.ends('e')} AND ({_Step.m_gt1(p)} OR "
            f"({_Step.m_eq1(p)} AND NOT {s.cvc(s.stem(1), p)})) "
            f"THEN {s.stem(1)} ELSE {s.w} END")


def _step5b(s: _Step) -> str:
    return (f"CASE WHEN {s.ends('ll')} AND {_Step.m_gt1(s.pat(1))} "
            f"THEN {s.stem(1)} ELSE {s.w} END")


# (step, needs the pattern of its input word)
_STEPS = [(_step1a, False), (_step1b, True), (_step1c, True), (_step2_alli, True), (_step2, True),
          (lambda s: s.rules(_STEP3), True), (_step4, True), (_step5a, True), (_step5b, True)]


# suffixes after which each step reads the pattern of its word (by step position)
_PATTERN_SUFFIXES = {
    1: ["eed", "ed", "ing"],
    2: ["y"],
    3: ["alli"],
    4: [x for x, _, _ in _STEP2] + ["logi"],
    5: [x for x, _, _ in _STEP3],
    6: ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
        "ou", "ism", "ate", "iti", "ous", "ive", "ize"],
    7: ["e"],
    8: ["ll"],
}


def _step_groups(d: Dialect, word: str, tag: str):
    """``(name, helpers, expr)`` per step; ``helpers`` are ``(name, expr)`` bindings the
    step expression reads (the pattern of its input word, the -ed / -ing stems)."""
    n = len(_STEPS)
    groups = [(f"{tag}w0", [], ascii_lower(d, word))]
    for i in range(n):
        w, c = f"{tag}w{i}", f"{tag}c{i}"
        step, needs_pattern = _STEPS[i]
        st = _Step(d, w, c)
        helpers = []
        if needs_pattern:
            # the pattern is only read after a suffix of this step matched
            guard = " OR ".join(st.ends(x) for x in _PATTERN_SUFFIXES[i])
            helpers.append((f"{c}y", f"CASE WHEN {guard} THEN {_letters(d, w)} ELSE '' END"))
            helpers.append((c, _pattern(d, f"{c}y")))
        if step is _step1b:
            ed, ing = f"{tag}ed", f"{tag}ing"
            helpers.append((ed, f"CASE WHEN length({w}) >= 2 THEN {st.stem(2)} ELSE '' END"))
            helpers.append((ing, f"CASE WHEN length({w}) >= 3 THEN {st.stem(3)} ELSE '' END"))
            expr = step(st, ed, ing)
        else:
            expr = step(st)
        groups.append((f"{tag}w{i + 1}", helpers, expr))
    w0, last = f"{tag}w0", f"{tag}w{n}"
    irregular = " ".join(f"WHEN {d.lit(a)} THEN {d.lit(b)}" for a, b in IRREGULAR_FORMS)
    groups.append((f"{tag}stem", [], f"CASE {w0} {irregular} ELSE "
                                     f"CASE WHEN length({w0}) <= 2 THEN {w0} ELSE {last} END END"))
    return groups


def stem_steps(d: Dialect, word: str, tag: str = "p") -> list[tuple[str, str]]:
    """The stemmer as a list of ``(name, expression)`` pairs, each reading earlier names.

    Binding each name to a column (``withColumn``) keeps every step inside whole-stage
    code generation. The last name holds the stem.
    """
    out = []
    for name, helpers, expr in _step_groups(d, word, tag):
        out += helpers
        out.append((name, expr))
    return out


def stem_sql(d: Dialect, word: str, tag: str = "p") -> str:
    """The stemmer as one SQL expression over the single-word expression ``word``.

    Steps are chained with let-bindings; a step's helper bindings are nested inside its
    own value, which keeps the chain shallow (engines bind nested lambdas slowly).
    ``tag`` prefixes the lambda variables so the expression can sit inside another
    lambda (for example ``transform(tokens, t -> <stem of t>)``).
    """
    groups = _step_groups(d, word, tag)
    body = groups[-1][2]
    for name, helpers, expr in reversed(groups[:-1]):
        for hname, hexpr in reversed(helpers):
            expr = d.let(hexpr, hname, expr)
        body = d.let(expr, name, body)
    return body


def word_stemmer():
    """The same steps as a function of one word (str -> str), for Arrow UDFs.

    The function is nested and holds its tables, so it is sent to Python workers by value:
    they need not have this package on their path.
    """
    lower = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    classes = str.maketrans(_LETTERS, _CLASSES)
    irregular = dict(IRREGULAR_FORMS)
    step2 = [(suffix, repl) for suffix, repl, _ in _STEP2]
    step3 = [(suffix, repl) for suffix, repl, _ in _STEP3]
    step4 = _PATTERN_SUFFIXES[6]
    # a word without one of these at its end goes through the step unchanged
    ends2, ends3 = (*[x for x, _ in step2], "logi"), tuple(x for x, _ in step3)
    ends4 = tuple(step4)

    def pattern(w: str) -> str:
        p = w.translate(classes)
        if "y" not in p:
            return p
        out, before = [], ""
        for i, x in enumerate(p):
            if x == "y":
                x = "C" if i == 0 or before == "V" else "V" if before == "C" else "y"
            out.append(x)
            before = x
        return "".join(out)

    def cvc(s: str, p: str) -> bool:
        return (p.endswith("CVC") and s[-1:] not in ("w", "x", "y")) or p == "VC"

    def tail(v: str, p: str) -> str:
        if v.endswith(("at", "bl", "iz")):
            return v + "e"
        if len(v) >= 2 and v[-1] == v[-2] and p.endswith("C"):
            return v if v[-1] in "lsz" else v[:-1]
        return v + "e" if p.count("VC") == 1 and cvc(v, p) else v

    def stem(word: str) -> str:
        w = word.translate(lower)
        if w in irregular:
            return irregular[w]
        if len(w) <= 2:
            return w
        if w.endswith("s"):  # 1a
            if w.endswith("ies"):
                w = w[:-3] + ("ie" if len(w) == 4 else "i")
            elif w.endswith("sses"):
                w = w[:-2]
            elif not w.endswith("ss"):
                w = w[:-1]
        if w.endswith("ied"):  # 1b
            w = w[:-3] + ("ie" if len(w) == 4 else "i")
        elif w.endswith("eed"):
            w = w[:-1] if "VC" in pattern(w)[:-3] else w
        elif w.endswith("ed"):
            p = pattern(w)[:-2]
            w = tail(w[:-2], p) if "V" in p else w
        elif w.endswith("ing"):
            p = pattern(w)[:-3]
            w = tail(w[:-3], p) if "V" in p else w
        if w.endswith("y") and len(w) > 2 and pattern(w)[-2] == "C":  # 1c
            w = w[:-1] + "i"
        if w.endswith("alli") and "VC" in pattern(w)[:-4]:  # 2, -alli first
            w = w[:-2]
        if w.endswith(ends2):
            for suffix, repl in step2:
                if w.endswith(suffix):
                    w = w[:-len(suffix)] + repl if "VC" in pattern(w)[:-len(suffix)] else w
                    break
            else:  # the 'l' of -logi stays with the stem for the measure test
                w = w[:-1] if "VC" in pattern(w)[:-3] else w
        if w.endswith(ends3):
            for suffix, repl in step3:
                if w.endswith(suffix):
                    w = w[:-len(suffix)] + repl if "VC" in pattern(w)[:-len(suffix)] else w
                    break
        if w.endswith(ends4):
            for suffix in step4:
                if w.endswith(suffix):
                    left = w[:-len(suffix)]
                    if pattern(w)[:-len(suffix)].count("VC") > 1 and (suffix != "ion" or left[-1:] in ("s", "t")):
                        w = left
                    break
        if w.endswith("e"):  # 5a
            p = pattern(w)[:-1]
            m = p.count("VC")
            w = w[:-1] if m > 1 or (m == 1 and not cvc(w[:-1], p)) else w
        if w.endswith("ll") and pattern(w)[:-1].count("VC") > 1:  # 5b
            w = w[:-1]
        return w

    return stem
