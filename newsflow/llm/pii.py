"""Operator 2, personal data [native]: candidate gradient boosting, in DataFrame functions only.

* Base spans: four patterns, leftmost and non-overlapping per kind, matches that fail their check are
  dropped without a retry. They always stay.
* Candidates: further patterns of high recall (spelt-out mail addresses, defanged and IPv6 addresses,
  card numbers with other separators or beside other numbers, national phone numbers and such that run
  into other digits). They may overlap each other and base spans.
* Each candidate gets format and context features and a sum of boosted trees over them. Those whose
  score reaches the threshold of their kind stand, and of overlapping ones the best stays: in order of
  score, whatever overlaps one that stays goes. Base spans come before all candidates.

Training (``fit``): labelled texts are made by a rule (TEMPLATES, rows of spark.range), go through the
same candidate and feature expressions, and their features, some thousand small rows, are boosted on
the driver in numpy. Thresholds are calibrated on templates that the trees have not seen: each of FOLDS
models scores the templates left out of its training; the threshold of a kind is the least score from
which on the precision of these scores is at least PRECISION. The trees become nested CASE expressions.

Work grows with the text: patterns are written so that the Java engine needs linear time and no stack
(runs are possessive, and a run is entered only at its start or where the match before ended), and
places come from running sums over blocks of matches (``_before``). Expressions are SQL text, which is
parsed at once where building them call by call takes seconds.

Defined results: null is read as the empty text, which has no spans; offsets are code points, the end
exclusive; repeated rows get equal results; an empty table gives an empty table; all columns pass
through, those named like ours are replaced.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Order of kinds in results.
KINDS = ("email", "ip", "card", "phone")

# The base patterns, and what a text must hold for one to be tried. A card number has 14
# digits at least, so shorter runs need not match: runs are matched whole.
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
# The patterns of further candidates, several of a kind.
MORE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({] ?(?:at|AT|@) ?[\])}] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[({] ?(?:dot|DOT|\.) ?[\])}]) ?[A-Za-z0-9-]{1,63}+){1,5}"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ (?:at|AT) [A-Za-z0-9-]{1,63}+(?: (?:dot|DOT) [A-Za-z0-9-]{2,63}+){1,4}"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}){3}(?![0-9])"),
    ("ip", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9A-Za-z.])[0-9]{4}(?:[ ./_-]{1,2}[0-9]{4}){3}(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z.])[0-9]{14,19}+(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z.,+#=/-])(?:00[1-9][0-9]{0,2}[ ./-]?)?(?:\(0?[0-9]{2,4}\)|0[0-9]{2,4}|[0-9]{3})[ ./-]{1,2}[0-9]{3,4}[ ./-]?[0-9]{3,5}(?![0-9A-Za-z])"),
    ("phone", r"\+[1-9][0-9]{0,2}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])"),
)
# Words before a span that speak for a kind, and such that speak against personal data.
FOR = {"email": "mail|contact|write|kontakt|courriel|correo|reach", "ip": "ip|host|server|address|login|adresse|node", "card": "card|visa|credit|pay|karte|carte|tarjeta|charge", "phone": "phone|tel|call|fax|mobile|cell|ruf|appel|llam|reach|dial"}
AGAINST = "order|invoice|version|isbn|ref|serial|page|section|part|date|year|price|total|item|nummer|no\\.|nr\\.|hash|key|checksum|build|batch"
LEFT = 24

#: (kind, personal, text): # is a digit and ~ a hexadecimal digit that a hash chooses.
TEMPLATES = (
    ("email", 1, "please mail to anna.b##(at)mail#.example.com today"), ("email", 1, "contact jo## [at] host# [dot] example [dot] org"), ("email", 1, "write: k.lee## (at) web.example.net or not"), ("email", 1, "e-mail max##{at}post#.example.de"),
    ("email", 1, "kontakt: eva_##(AT)firma#.example.de danke"), ("email", 1, "mail sam## at example dot com for more"), ("email", 1, "reach lee.## at host# dot example dot org"), ("email", 1, "courriel: marc## [at] site#.example.fr"), ("email", 1, "mail us: desk## (@) shop.example.co"),
    ("email", 0, "meet me (at) home.base## or there"), ("email", 0, "he ran [at] full.speed## and more"), ("email", 0, "f(at) x.y## is null here"), ("email", 0, "part ## (at) section.####"), ("email", 0, "look at the dot com boom of 19##"), ("email", 0, "version ## (at) build.####"), ("email", 0, "stay at red dot inn ##"), ("email", 0, "page ## {at} item.##"),
    ("ip", 1, "server ip ##[.]##[.]#[.]## is down"), ("ip", 1, "login from 1##[.]##[.]1#[.]2#"), ("ip", 1, "host 10(.)##(.)#(.)##"), ("ip", 1, "address 1##[dot]##[dot]##[dot]#"), ("ip", 1, "node 20~~:0db8:85a~:0000:0000:8a2~:0370:73~~ is up"), ("ip", 1, "ip fe80:0:0:0:~~~:~~ff:fe~~:~~~~ replied"), ("ip", 1, "blocked ##[.]1#[.]2#[.]##"), ("ip", 1, "from 20~~:~~~~:~~~~:~:~:~~~~:~~:~"),
    ("ip", 0, "version #[.]#[.]#[.]# is out"), ("ip", 0, "section 9##[.]7##[.]8##[.]9##"), ("ip", 0, "part 6##[.]#[.]#[.]#"), ("ip", 0, "serial 9##(.)9##(.)9##(.)9##"), ("ip", 0, "key ~~:~~:~~:~~:~~:~~:~~:~~"), ("ip", 0, "hash ~~:~~:~~:~~:~~:~~:~~:~~ is wrong"), ("ip", 0, "build #(.)#(.)##(.)####"), ("ip", 0, "checksum 0~:~~:~~:~~:~~:~~:~~:~~"),
    ("card", 1, "card 4###.####.####.#### valid"), ("card", 1, "visa 4###/####/####/#### please"), ("card", 1, "pay with 5###_####_####_####"), ("card", 1, "credit card: 4###--####--####--####"), ("card", 1, "charge 4############### 5############### now"), ("card", 1, "cards 4############### 4###############"), ("card", 1, "4###.####.####.#### is my karte"), ("card", 1, "use 5###/####/####/####"), ("card", 1, "pay 3############## 4###############"),
    ("card", 0, "order 1###.####.####.#### shipped"), ("card", 0, "serial 0###/####/####/####"), ("card", 0, "ref 9###_####_####_####"), ("card", 0, "invoice 7###..####..####..####"), ("card", 0, "batch 1############### 0###############"), ("card", 0, "key 9############## 8##############"), ("card", 0, "item 0###.####.####.####"), ("card", 0, "total 1############### 2###############"),
    ("phone", 1, "call (###) 555-#### now"), ("phone", 1, "tel 0## 555 ####"), ("phone", 1, "phone ###-555-####"), ("phone", 1, "mobile 0###/555####"), ("phone", 1, "fax: 0049 ### 555 ####"), ("phone", 1, "my cell ###.555.####"), ("phone", 1, "you can reach me: (###) ###-####"), ("phone", 1, "call +1 (###) ###-#### 10.##.#.## today"), ("phone", 1, "+1 (###) ###-#### 1##.##.1##.##"), ("phone", 1, "dial +49 ### ### #### 20## or so"), ("phone", 1, "tel (0##) ###-#### weekdays"),
    ("phone", 0, "isbn ###-###-####"), ("phone", 0, "order ### ### ####"), ("phone", 0, "invoice ###-####-####"), ("phone", 0, "ref ### #### #####"), ("phone", 0, "price ### ### ####"), ("phone", 0, "version ###.###.####"), ("phone", 0, "total 0## ### ###"), ("phone", 0, "they sold ### ### ### pieces"), ("phone", 0, "date 0## 2## ####"), ("phone", 0, "serial ###-###-####"), ("phone", 0, "between ### ### #### and more"), ("phone", 0, "batch 0## ### #### left"),
)
#: Examples of a template; of cards more, as one in ten passes its check.
EXAMPLES, CARD_EXAMPLES, FOLDS = 80, 400, 4
ROUNDS, DEPTH, RATE, PRECISION = 25, 3, 0.3, 0.98


def _let(x: str, name: str, body: str) -> str:
    """body over ``name``, which is x, computed once."""
    return f"transform(array({x}), {name} -> {body})[0]"


def _before(items: str, value, merge) -> str:
    """For each of ``items``, what ``merge`` (associative, 0 at first) makes of the values before it.

    Appending one by one copies the array each time; blocks of about the root of its size, carried on
    block by block, keep that to size ** 1.5.
    """
    def fold(arr: str, of) -> str:
        return f"aggregate({arr}, named_struct('v', 0, 'out', CAST(array() AS array<int>)), (a_, x_) -> named_struct('v', {merge('a_.v', of('x_'))}, 'out', concat(a_.out, array(a_.v))))"

    width = f"CAST(ceil(sqrt(size({items}))) AS INT)"
    blocks = f"transform(sequence(0, size({items}) - 1, {width}), i_ -> {fold(f'slice({items}, i_ + 1, {width})', value)})"
    carried = fold("b_", lambda x: f"{x}.v")
    whole = _let(blocks, "b_", f"flatten(zip_with(b_, {carried}.out, (y_, m_) -> transform(y_.out, o_ -> {merge('o_', 'm_')})))")
    return f"CASE WHEN size({items}) > 0 THEN {whole} ELSE CAST(array() AS array<int>) END"


SPAN = "array<struct<s: int, e: int, m: string, ctx: string>>"


def _found(text: str, pattern: str, valid=lambda m: "true", needs: str | None = None) -> str:
    """All valid matches as SPAN, s and e in code points: what lies between the matches gives their places. ctx: LEFT characters before."""
    p = f"r'{pattern}'"
    matches = _let(f"regexp_extract_all({text}, {p}, 0)", "m_", "zip_with(m_, slice(concat(array(''), m_), 1, size(m_)), (x_, l_) -> named_struct('m', x_, 'last', l_))")
    part = f"CASE WHEN x_ IS NOT NULL THEN named_struct('g', length(g_), 'n', length(x_.m), 'm', x_.m, 'ctx', right(concat(right(x_.last, {LEFT}), right(g_, {LEFT})), {LEFT})) END"
    parts = f"filter(zip_with(split({text}, {p}, -1), {matches}, (g_, x_) -> {part}), x_ -> x_ IS NOT NULL)"
    at = _before("p_", lambda x: f"{x}.g + {x}.n", lambda a, b: f"{a} + {b}")
    spans = f"zip_with(p_, {at}, (x_, a_) -> named_struct('s', a_ + x_.g, 'e', a_ + x_.g + x_.n, 'm', x_.m, 'ctx', x_.ctx))"
    maybe = f"contains({text}, '{needs}') AND " if needs else ""
    return f"CASE WHEN {maybe}regexp_like({text}, {p}) THEN {_let(parts, 'p_', f'filter({spans}, x_ -> {valid("x_.m")})')} ELSE CAST(array() AS {SPAN}) END"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(m: str) -> str:
    """Whether the 14 to 19 digits of m pass the Luhn check; false for other numbers of digits."""
    digit = "CAST(substring(d_, length(d_) - i_, 1) AS INT)"
    total = f"aggregate(sequence(0, length(d_) - 1), 0, (t_, i_) -> t_ + CASE WHEN i_ % 2 = 1 THEN {digit} * 2 - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END ELSE {digit} END)"
    return _let(_digits(m), "d_", f"CASE WHEN length(d_) BETWEEN 14 AND 19 THEN {total} % 10 = 0 ELSE false END")


def _valid(kind: str, m: str) -> str:
    if kind == "ip":
        return rf"{m} RLIKE r'^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){{3}}$'"
    if kind == "card":  # 19 digits with a sign between any two are 37 characters
        return f"CASE WHEN length({m}) <= 37 THEN {_luhn(m)} ELSE false END"
    if kind == "phone":
        return f"length({_digits(m)}) BETWEEN 10 AND 15"
    return "true"


def base_spans(text: str) -> str:
    """SQL for array<struct<s, k, e>> in order; text: SQL, k: the index of the kind."""
    def of(k: int, kind: str) -> str:
        pattern, needs = BASE[kind]
        return f"transform({_found(text, pattern, lambda m: _valid(kind, m), needs)}, z_ -> named_struct('s', z_.s, 'k', {k}, 'e', z_.e))"

    return f"array_sort(concat({', '.join(of(k, kind) for k, kind in enumerate(KINDS))}))"


FEATURES = ("kind", "form", "digits", "letters", "length", "signs", "distinct", "luhn", "for_it", "against", "after_sign", "brackets", "zero", "large", "longest", "first")


def _features(k: int, form: int) -> str:
    """Features of the candidate z_."""
    digits, left = _digits("z_.m"), "lower(z_.ctx)"
    runs = "filter(split(regexp_replace(z_.m, '[^0-9]+', ' '), ' '), q_ -> q_ <> '')"
    flag = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
    values = (
        str(k), str(form), f"length({digits})", "length(regexp_replace(z_.m, '[^A-Za-z]', ''))", "length(z_.m)", "length(regexp_replace(z_.m, '[A-Za-z0-9]', ''))",
        f"size(array_distinct(split({digits}, '')))", flag(_luhn("z_.m")), flag(f"{left} RLIKE r'(?:{FOR[KINDS[k]]})[^0-9]*$'"),
        flag(f"{left} RLIKE r'{AGAINST}'"), flag(rf"{left} RLIKE r'[#$€£=%]\s*$'"), flag("contains(z_.m, '(')"), flag("startswith(z_.m, '0') OR startswith(z_.m, '(0')"),
        flag(f"exists({runs}, q_ -> length(q_) >= 3 AND CAST(substring(q_, 1, 4) AS INT) > 255)"), f"coalesce(array_max(transform({runs}, q_ -> length(q_))), 0)", f"coalesce(try_cast(substring({digits}, 1, 1) AS INT), -1)",
    )
    return f"array({', '.join(values)})"


def candidates(text: str) -> str:
    """SQL for array<struct<s, k, e, f>> of spans by the further patterns; f: their features."""
    def of(form: int, kind: str, pattern: str) -> str:
        k = KINDS.index(kind)
        return f"transform({_found(text, pattern)}, z_ -> named_struct('s', z_.s, 'k', {k}, 'e', z_.e, 'f', {_features(k, form)}))"

    return f"concat({', '.join(of(form, kind, pattern) for form, (kind, pattern) in enumerate(MORE))})"


def unrivalled(base: str, chosen: str) -> Column:
    """base with those of chosen (p, s, k, e) that stay beside it and each other, best score first, in order; both are column names."""
    ranked = f"array_sort(concat(transform({base}, x_ -> named_struct('s', x_.s, 'e', x_.e, 'p', CAST('Infinity' AS DOUBLE), 'k', x_.k)), transform({chosen}, x_ -> named_struct('s', x_.s, 'e', x_.e, 'p', x_.p, 'k', x_.k))))"
    kind = "array<struct<less: double, s: int, k: int, e: int>>"
    order = "array_sort(transform(c_, x_ -> named_struct('less', -x_.p, 's', x_.s, 'k', x_.k, 'e', x_.e)))"
    settled = f"aggregate({order}, CAST(array() AS {kind}), (k_, x_) -> CASE WHEN x_.less = CAST('-Infinity' AS DOUBLE) OR NOT exists(k_, o_ -> o_.s < x_.e AND o_.e > x_.s) THEN concat(k_, array(x_)) ELSE k_ END)"
    # spans that hang together by overlaps are settled each cluster on its own
    reach = _before("r_", lambda x: f"{x}.e", lambda a, b: f"greatest({a}, {b})")
    begins = f"filter(zip_with({reach}, transform(r_, (x_, i_) -> named_struct('s', x_.s, 'i', i_)), (y_, x_) -> CASE WHEN y_ <= x_.s THEN x_.i END), i_ -> i_ IS NOT NULL)"
    clusters = "zip_with(n_, concat(slice(n_, 2, size(n_)), array(size(r_))), (a_, b_) -> slice(r_, a_ + 1, b_ - a_))"
    every = _let(ranked, "r_", _let(begins, "n_", f"flatten(transform({clusters}, c_ -> {settled}))"))
    return F.expr(f"CASE WHEN size({chosen}) > 0 THEN array_sort(transform({every}, x_ -> named_struct('s', x_.s, 'k', x_.k, 'e', x_.e))) ELSE {base} END")


@dataclasses.dataclass
class Model:
    """Boosted trees as nested tuples (feature, limit, left, right) or leaf values, and a threshold per kind on their sum."""

    trees: list
    bias: float
    thresholds: list[float]

    def sums(self, x: np.ndarray) -> np.ndarray:
        def value(tree, rows):
            if not isinstance(tree, tuple):
                return np.full(len(rows), tree)
            low = rows[:, tree[0]] <= tree[1]
            out = np.empty(len(rows))
            out[low], out[~low] = value(tree[2], rows[low]), value(tree[3], rows[~low])
            return out

        return self.bias + sum((value(t, x) for t in self.trees), np.zeros(len(x)))

    def sql(self, f: str) -> str:
        """The sum of all trees over an array of features, as SQL."""
        def of(tree) -> str:
            if not isinstance(tree, tuple):
                return f"{float(tree)!r}D"
            return f"CASE WHEN {f}[{tree[0]}] <= {int(tree[1])} THEN {of(tree[2])} ELSE {of(tree[3])} END"

        return " + ".join([f"{self.bias!r}D", *map(of, self.trees)])

    def least(self, k: str) -> str:
        """The threshold of kind k, as SQL."""
        return f"array({', '.join(f"CAST('{'Infinity' if t == float('inf') else repr(float(t))}' AS DOUBLE)" for t in self.thresholds)})[{k}]"


def _tree(x: np.ndarray, w: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree on gradients and curvatures by exact greedy splits, w: how often each row occurs; None of gain: a leaf."""
    gain = lambda a, b: a * a / (b + 1.0)
    best = (1e-6, None, None)
    if depth and w.sum() >= 20:
        for j in range(x.shape[1]):
            limits, of = np.unique(x[:, j], return_inverse=True)
            n, gl, hl = (np.cumsum(np.bincount(of, v))[:-1] for v in (w, g, h))
            won = np.where((n >= 5) & (w.sum() - n >= 5), gain(gl, hl) + gain(g.sum() - gl, h.sum() - hl) - gain(g.sum(), h.sum()), -1.0)
            if len(won) and won.max() > best[0] + 1e-9:
                best = (won.max(), j, limits[won.argmax()])
    if best[1] is None:
        return float(-RATE * g.sum() / (h.sum() + 1.0))
    low = x[:, best[1]] <= best[2]
    return (int(best[1]), int(best[2]), _tree(x[low], w[low], g[low], h[low], depth - 1), _tree(x[~low], w[~low], g[~low], h[~low], depth - 1))


def _grown(x: np.ndarray, y: np.ndarray) -> Model:
    """Trees for logistic loss, one after another."""
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    rows, w = np.unique(np.column_stack([x, y.astype(int)]), axis=0, return_counts=True)
    x, y = rows[:, :-1], rows[:, -1]
    model, total = Model([], bias, [0.0] * len(KINDS)), np.full(len(y), bias)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-total))
        tree = _tree(x, w, w * (p - y), w * p * (1 - p), DEPTH)
        model.trees.append(tree)
        total += Model([tree], 0.0, []).sums(x)
    return model


def unseen_scores(x: np.ndarray, y: np.ndarray, template: np.ndarray) -> np.ndarray:
    """Scores of all rows by models that have not seen the row's template."""
    out = np.zeros(len(x))
    for fold in range(FOLDS):
        held = template % FOLDS == fold
        if held.any():
            out[held] = _grown(x[~held], y[~held]).sums(x[held])
    return out


def boost(x: np.ndarray, y: np.ndarray, template: np.ndarray) -> Model:
    """Trees on all rows; thresholds from scores of unseen templates."""
    model, sums = _grown(x, y), unseen_scores(x, y, template)
    for k in range(len(KINDS)):
        own = x[:, 0] == k
        order = np.argsort(-sums[own], kind="stable")
        s, right = sums[own][order], np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        last = np.append(s[1:] != s[:-1], True)[: len(s)]  # ties share a threshold
        good = np.flatnonzero((right >= PRECISION) & last)
        if len(good):  # half way to the next lower score
            low = good[-1]
            model.thresholds[k] = float((s[low] + s[low + 1]) / 2 if low + 1 < len(s) else s[low] - 1.0)
        else:
            model.thresholds[k] = float("inf")
    return model


def examples(spark: SparkSession) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and templates of the candidates in the texts that TEMPLATES make."""
    made = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(y).alias("y"), F.lit(t).alias("t"), F.lit(CARD_EXAMPLES if kind == "card" else EXAMPLES).alias("n")) for i, (kind, y, t) in enumerate(TEMPLATES)])
    rows = spark.range(0, CARD_EXAMPLES, 1, 1).select("id", F.explode(made).alias("x")).where("id < x.n").select("id", "x.*")
    digit = lambda i: F.pmod(F.xxhash64("id", "i", i), F.lit(10)).cast("string")
    hexa = lambda i: F.substring(F.lit("0123456789abcdef"), F.pmod(F.xxhash64("id", "i", i), F.lit(16)).cast("int") + 1, F.lit(1))
    text = F.array_join(F.transform(F.split("t", ""), lambda c, i: F.when(c == "#", digit(i)).when(c == "~", hexa(i)).otherwise(c)), "")
    rows = rows.select("id", "i", "y", text.alias("text"))
    found = rows.select("id", "i", "y", F.explode(F.expr(candidates("text"))).alias("c")).select("id", "i", "y", "c.s", "c.f").orderBy("i", "id", "s", "f").collect()
    x = np.array([r.f for r in found], int).reshape(-1, len(FEATURES))
    y = np.array([r.y for r in found], int)
    # a card number must also pass its check
    y = y & ((x[:, 0] != KINDS.index("card")) | (x[:, FEATURES.index("luhn")] == 1))
    return x, y.astype(float), np.array([r.i for r in found], int)


def fit(spark: SparkSession) -> Model:
    """A model from the labelled texts that TEMPLATES make."""
    return boost(*examples(spark))


def find(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with base_found and found: array<struct<s, k, e>> of base spans and of all spans, in order."""
    text = f"coalesce(`{text_col}`, '')"
    scored = f"transform({candidates(text)}, c_ -> named_struct('p', {model.sql('c_.f')}, 's', c_.s, 'k', c_.k, 'e', c_.e))"
    more = docs.drop("base_found", "found", "__more").withColumns({"base_found": F.expr(base_spans(text)), "__more": F.expr(f"filter({scored}, c_ -> c_.p >= {model.least('c_.k')})")})
    return more.withColumn("found", unrivalled("base_found", "__more")).drop("__more")


def named(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"], x["e"])), ",")


def redact(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """text with every span replaced by ``mark``; overlapping spans count as one."""
    kind = "array<struct<a: int, b: int>>"
    merge = F.aggregate(
        spans, F.array().cast(kind),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= x["s"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["b"], x["e"]).alias("b"))))).otherwise(F.concat(acc, F.array(F.struct(x["s"].alias("a"), x["e"].alias("b"))))),
    )
    after = F.concat(F.array(F.lit(0)), F.transform(merge, lambda m: m["b"]))
    until = F.concat(F.transform(merge, lambda m: m["a"]), F.array(F.length(text)))
    return F.array_join(F.zip_with(after, until, lambda a, b: F.substring(text, a + 1, b - a)), mark)
