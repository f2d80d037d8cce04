"""Sentence boundaries across languages and scripts.

Method: every character gets the tag *boundary* or *inside*; the tags of a unit
(a stretch without a blank line) are decoded together with Viterbi under a
linear-chain model.  Characters that can't end a sentence (no closing mark and,
in unpunctuated scripts, no space) have the tag inside, so only the remaining
places need scores.

A place's features are windows of characters on both sides, the words there and
what is known about them (their case, script, whether the word is an
abbreviation, the mark, quotations around it), alone and in twos and threes.  No
feature says what a rule would decide.

The model is an averaged structured perceptron trained here: on a bounded
sample of the documents (``TRAIN_ROWS`` texts by hash order, a documented
parameter) whose labels come from closing marks, case, abbreviations, quotation
and brackets.  For unpunctuated scripts (Thai, Lao) the sample is stripped of
its closing marks: the label is what the mark said, the features are those of
the text without it, so the model has to tell boundary spaces from others by
what stands beside them.

Abbreviations are learned from counts over *all* documents: words of up to six
letters whose full stop is mostly followed by a small letter or a digit, if they
stand LEAST_COUNT times or more.  They are a table, joined to the documents that
hold them; no list is gathered.

Defined results: null, empty and blank texts have no sentences; a text without
any mark is one sentence per unit; repeated rows count once; texts aren't cut,
whatever their length.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.runtime import cut, parallelism, partitions

TRAIN_ROWS, TRAIN_CHARS, EPOCHS = 2_000, 20_000, 30
LEAST_COUNT = 5
MARGIN = 4.0

# Abbreviations that stand before a name, a number or another word, by what may follow.
BEFORE_NAME = frozenset("dr prof mr mrs ms st mt sr sra srta dra hr fr frau mme mlle mm me mgr rev hon gen col capt lt sgt gov sen rep pres messrs dipl ing bzw z u d h vgl ca sog ggf evtl bes vs cf viz e.g i.e z.b d.h u.a ung р см гг ул пр им акад проф др г-н г-жа д-р डॉ श्री د أ م ul dott sig".split())
BEFORE_NUMBER = frozenset("no nos nr nrn fig figs sec secs p pp ch chap vol vols eq eqs art arts par abs abb tab s bd kap núm pág págs cap рис табл стр с гл п т fig. tel max min approx jan feb mar apr jun jul aug sep sept oct nov dec".split())
# Abbreviations that also end sentences.
MAY_END = frozenset("etc usw u.s.w al p.m a.m inc ltd co corp jr jr. т.д т.п д п г гг др ff bc ad u.s u.k e.v".split())
# Month names after which a German, Danish or Norwegian day ordinal isn't the end.
MONTHS = frozenset("januar jänner februar märz april mai juni juli august september oktober november dezember".split())

# Words of one letter.
ONE_LETTER_WORDS = frozenset("яиоуаюayoeuàéè")

STOPS = ".!?…。！？．।॥؟۔‼⁇⁈⁉｡។៕။"
CLOSERS = "”’»›\"')]}」』）】》〉］｝"
_CLOSING = set(CLOSERS)
_BLANK = regex.compile(r"\r?\n[^\S\n]*(?:\r?\n[^\S\n]*)+")
_HEADING = regex.compile(r"(?m)^[ \t]*#{1,6}[ \t]+[^\n]*$")
_RUN = regex.compile(rf"[{regex.escape(STOPS)}]+(?:[^\S\n]?[»›](?!\w)|[{regex.escape(CLOSERS)}“]|[{regex.escape(STOPS)}])*")
_THAI = regex.compile(r"[\u0e00-\u0eff]")
_LETTER = regex.compile(r"\p{L}")
_GAP = regex.compile(r"[^\S\n]+")
_TOKEN_BEFORE = regex.compile(r"[\p{L}\p{M}\p{N}.'’-]*[\p{L}\p{M}\p{N}]$")
_NEXT = regex.compile(r"\s*([—–-]?\s*)([\"“”„«‹‘'¿¡(\[「『（【《*_]*\s?)([\p{L}\p{M}\p{N}]*)")
_PAIRS = {"“": "”", "«": "»", "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "【": "】", "《": "》", "„": "“"}


def _quoted(unit: str) -> list[tuple[int, int, int]]:
    """(start, end, 1 if it begins after text of the same unit) of quotations and brackets that are closed in the unit."""
    out, stack = [], []
    straight = [i for i, c in enumerate(unit) if c == '"']
    opens = set(straight[0::2]) if len(straight) % 2 == 0 else set()
    shuts = set(straight[1::2]) if opens else set()
    for i, c in enumerate(unit):
        if c in "“«「『（([【《„" and not (c == "“" and stack and stack[-1][0] == "„"):
            stack.append((c, i))
        elif c == '"' and i in opens:
            stack.append(('"', i))
        elif stack and ((c == '"' and i in shuts and stack[-1][0] == '"') or c == _PAIRS.get(stack[-1][0])):
            start = stack.pop()[1]
            out.append((start, i, 0))
        elif c in "”»」』）)]】》":
            for j in range(len(stack) - 1, -1, -1):
                if _PAIRS.get(stack[j][0]) == c:
                    out.append((stack[j][1], i, 0))
                    del stack[j:]
                    break
    return out


def _kind(ch: str) -> str:
    if not ch:
        return "end"
    if ch.isdigit():
        return "digit"
    if ch.isupper() or unicodedata.category(ch) == "Lt":
        return "upper"
    if ch.islower():
        return "lower"
    if "぀" <= ch <= "ゟ":
        return "hiragana"
    if ch.isalpha() or unicodedata.category(ch)[0] == "M":
        return "caseless"
    return "mark"


def _before(unit: str, at: int, learned: frozenset) -> tuple[str, str]:
    """(kind of the word before the stop, the word)."""
    m = _TOKEN_BEFORE.search(unit, max(0, at - 40), at)
    if not m:
        return "none", ""
    word = m.group().lstrip(".'’-")
    low = word.lower()
    if low.replace(".", "").replace(",", "").isdigit():
        line = unit.rfind("\n", 0, m.start()) + 1
        return ("item" if not unit[line : m.start()].strip() else "number"), low
    letters = sum(c.isalpha() for c in word)
    if letters == 1 and word.isupper():
        return "initial", low
    if low in MAY_END:
        return "may-end", low
    if low in BEFORE_NUMBER:
        return "before-number", low
    if low in BEFORE_NAME or low in learned:
        return "before-name", low
    if letters == 1 and word.isalpha() and low not in ONE_LETTER_WORDS:
        return "letter", low
    if "." in word and all(len(p) <= 2 for p in low.split(".")):
        return "dotted", low
    return "word", low


def _places(unit: str, learned: frozenset) -> list[tuple[int, dict]]:
    """(end, properties) of every place where a sentence may end; end is just after its closing marks."""
    thai = not unit.isascii() and len(_THAI.findall(unit)) * 2 > len(_LETTER.findall(unit))
    quotes = _quoted(unit)
    shuts_at = {e for _, e, _ in quotes}
    out: list[tuple[int, dict]] = []
    for m in _RUN.finditer(unit):
        end = m.end()
        # a mark that opens the next quotation isn't a closing one
        while end > m.start() + 1 and unit[end - 1] in "“\"'’([{":
            c = unit[end - 1]
            shut = end - 1 in shuts_at
            if c in "([{" or (c in '“"' and not shut) or (c in "'’" and end < len(unit) and unit[end : end + 1].isalpha()):
                end -= 1
                if unit[end - 1 : end].isspace():
                    end -= 1
            else:
                break
        if end == len(unit):
            continue
        run = unit[m.start() : end]
        closed = run[-1] not in STOPS
        begin = m.start()
        depth = any(s < begin and e >= end for s, e, _ in quotes)
        nxt = _NEXT.match(unit, end)
        dash, opener, word = nxt.group(1).strip() != "", nxt.group(2).strip() != "", nxt.group(3)
        follow = unit[nxt.end(2) : nxt.end(2) + 1]
        space = end < len(unit) and unit[end].isspace()
        before, low = _before(unit, m.start(), learned)
        kind = _kind(follow)
        mark = "dot" if run[0] in ".．" and len(run.rstrip(CLOSERS + "“ ")) == 1 else "dots" if run[0] in ".…" else "ask" if any(c in "?!？！؟‼⁇⁈⁉" for c in run) else "full"
        if mark == "dot" and not space and not closed and kind in ("lower", "digit", "mark", "caseless") and before != "none" and not opener:
            if kind != "caseless" or before in ("number", "item"):
                continue  # within a number, a file name or an address
        out.append(
            (
                end,
                {
                    "mark": mark,
                    "closed": closed,
                    "deep": depth,
                    "before": before if mark == "dot" else "any",
                    "next": kind,
                    "space": space,
                    "dash": dash,
                    "opener": opener,
                    "month": before in ("number", "item") and word.lower() in MONTHS,
                    "caseless_before": _kind(unit[m.start() - 1 : m.start()]) == "caseless" if m.start() else False,
                    "comma": kind == "mark" and follow in ",，、；;:：،؛",
                    "thai": thai,
                    "window": (unit[max(0, m.start() - 3) : m.start()], low, unit[nxt.end(2) : nxt.end(2) + 3].lower(), word.lower()),
                },
            )
        )
    if thai:
        taken = {e for e, _ in out}
        for m in _GAP.finditer(unit):
            if m.start() in taken or m.start() == 0 or m.end() == len(unit):
                continue
            left, right = unit[m.start() - 1], unit[m.end()]
            out.append((m.start(), {"mark": "gap", "closed": False, "deep": any(s < m.start() < e for s, e, _ in quotes), "before": "digit" if left.isdigit() else "any", "next": _kind(right), "space": True, "dash": False, "opener": False, "month": False, "caseless_before": True, "comma": right in ",;:" or left in ",;:", "thai": True, "window": (unit[max(0, m.start() - 3) : m.start()], "", unit[m.end() : m.end() + 3], "")}))
        out.sort(key=lambda x: x[0])
    return out


def _weak_label(p: dict) -> bool:
    """What closing marks, case, abbreviations and quotations say about a place."""
    if p["mark"] == "gap":
        return not (p["before"] == "digit" or p["next"] == "digit" or p["deep"] or p["comma"])
    if p["deep"] or p["comma"]:
        return False
    if p["next"] == "lower":
        return False
    if p["next"] == "hiragana" and p["closed"]:
        return False
    if p["closed"] and p["mark"] == "ask" and p["next"] == "caseless" and not p["opener"]:
        return False
    if p["mark"] == "dot" and not p["closed"]:
        b = p["before"]
        if b in ("before-name", "initial", "letter", "item"):
            return False
        if b == "dotted":
            return p["next"] == "upper" and not p["caseless_before"]
        if b == "before-number":
            return p["next"] in ("upper", "caseless") and not p["opener"]
        if b == "may-end":
            return p["next"] in ("upper", "caseless") or p["opener"]
        if b == "number":
            return not p["month"] and p["next"] != "digit"
        if not p["space"]:
            return p["next"] in ("upper", "caseless")
    return True


def _known(p: dict) -> tuple[str, ...]:
    """Features of what is known about a place; few places differ in all of it."""
    mark, nxt, before, closed, opener = p["mark"], p["next"], p["before"], p["closed"], p["opener"]
    return (
        "bias",
        f"mark={mark}",
        f"next={nxt}",
        f"mark={mark} next={nxt}",
        f"before={before}",
        f"before={before} next={nxt}",
        f"before={before} closed={closed}",
        f"before={before} next={nxt} opener={opener}",
        f"before={before} next={nxt} written={p['caseless_before']}",
        f"before={before} month={p['month']}",
        f"closed={closed} mark={mark} next={nxt}",
        f"closed={closed} mark={mark} next={nxt} opener={opener}",
        f"deep={p['deep']}",
        f"deep={p['deep']} mark={mark} closed={closed}",
        f"comma={p['comma']}",
        f"comma={p['comma']} mark={mark} closed={closed}",
        f"dash={p['dash']} mark={mark} next={nxt}",
        f"space={p['space']} mark={mark} next={nxt}",
        f"thai={p['thai']} mark={mark}",
    )


def _seen(p: dict) -> tuple[str, ...]:
    """Features of the characters and words around a place."""
    left, word, right, after = p["window"]
    return (f"l1={left[-1:]} {p['mark']}", f"l3={left}", f"r1={right[:1]}", f"r3={right}", f"lr={left[-1:]}{right[:1]}", f"w={word}", f"a={after}")


def _features(p: dict) -> tuple[str, ...]:
    return _known(p) + _seen(p)


#: Feature -> weight of the tag boundary against inside; ("step", x, y) -> weight of the tag y after x.
Model = dict


def decode(scores: list[float], model: Model) -> list[int]:
    """Best tags (1 boundary, 0 inside) of a chain of places by their scores of boundary against inside; before the first is inside."""
    step = [[model.get(("step", x, y), 0.0) for y in (0, 1)] for x in (0, 1)]
    score, back = [0.0, float("-inf")], []
    for emit in scores:
        link = [1 if score[1] + step[1][y] > score[0] + step[0][y] else 0 for y in (0, 1)]
        score = [score[link[0]] + step[link[0]][0], score[link[1]] + step[link[1]][1] + emit]
        back.append(link)
    if not back:
        return []
    y = 1 if score[1] > score[0] else 0
    tags = [y]
    for link in reversed(back[1:]):
        y = link[y]
        tags.append(y)
    return tags[::-1]


def viterbi(model: Model, rows: list[tuple[str, ...]]) -> list[int]:
    """Best tags of a chain of places by their features."""
    get = model.get
    return decode([sum([get(f, 0.0) for f in feats]) for feats in rows], model)


def train(chains: list[tuple[list[tuple[str, ...]], list[int]]], epochs: int = EPOCHS) -> Model:
    """Averaged structured perceptron of a linear chain with a margin: the right tags must win although every wrong one is given MARGIN."""
    w: Model = defaultdict(float)
    total: Model = defaultdict(float)
    turn = 1
    for _ in range(epochs):
        wrong = 0
        for feats, gold in chains:
            guess = decode([sum([w.get(f, 0.0) for f in fs]) + (MARGIN if y == 0 else -MARGIN) for fs, y in zip(feats, gold)], w)
            if guess != gold:
                wrong += 1
                changes: list[tuple[object, float]] = []
                a = b = 0
                for f, y, z in zip(feats, gold, guess):
                    if y != z:
                        changes += [(x, float(y - z)) for x in f]
                    if (a, y) != (b, z):
                        changes += [(("step", a, y), 0.5), (("step", b, z), -0.5)]
                    a, b = y, z
                for key, by in changes:
                    w[key] += by
                    total[key] += turn * by
            turn += 1
        if not wrong:
            break
    return {k: v - total[k] / turn for k, v in w.items() if v or total[k]}


def _units(text: str) -> list[tuple[int, int]]:
    """Stretches between blank lines; a heading line is a stretch of its own."""
    cuts = [(m.start(), m.end()) for m in _BLANK.finditer(text)]
    cuts += [(p, p) for m in _HEADING.finditer(text) for p in (m.start(), m.end())]
    out, at = [], 0
    for s, e in sorted(cuts):
        if s > at:
            out.append((at, s))
        at = max(at, e)
    out.append((at, len(text)))
    return [(s, e) for s, e in out if not text[s:e].isspace() and e > s]


def split(text: str, model: Model, learned: frozenset, cache: dict | None = None) -> list[tuple[int, int]]:
    """(start, end) of each sentence in code points, without outer white space."""
    out = []
    cache = {} if cache is None else cache
    get = model.get
    for s, e in _units(text):
        unit = text[s:e]
        places = _places(unit, learned)
        scores = []
        for _, p in places:
            window = p.pop("window")
            key = tuple(p.values())
            if key not in cache:
                cache[key] = sum(get(f, 0.0) for f in _known(p))
            p["window"] = window
            scores.append(cache[key] + sum([get(f, 0.0) for f in _seen(p)]))
        at = 0
        ends = [end for (end, _), y in zip(places, decode(scores, model)) if y]
        for end in [*ends, len(unit)]:
            part = unit[at:end]
            lead = len(part) - len(part.lstrip())
            body = part.strip()
            if body:
                out.append((s + at + lead, s + at + lead + len(body)))
            at = end
    return out


_SHORT = r"(?<![\p{L}\p{M}\p{N}.])([\p{L}\p{M}]{1,6}\.[ \t\u00a0]{1,2}[\p{L}\p{N}])"


def learned_abbreviations(documents: DataFrame) -> DataFrame:
    """(word): words whose full stop is mostly followed by a small letter or a digit, over all documents."""
    hits = documents.where("text is not null").select(F.explode(F.regexp_extract_all("text", F.lit(_SHORT), F.lit(1))).alias("hit"))
    word = F.lower(F.substring_index("hit", ".", 1))
    inside = F.regexp_like("hit", F.lit(r"[\p{Ll}\p{N}]$"))
    counts = hits.select(word.alias("word"), inside.cast("int").alias("inside")).groupBy("word").agg(F.count("*").alias("n"), F.sum("inside").alias("k"))
    return counts.where((F.col("n") >= LEAST_COUNT) & (F.col("k") > 0.8 * F.col("n"))).select("word")


def with_abbreviations(documents: DataFrame) -> DataFrame:
    """(doc_id, text, learned) of the distinct documents with text; learned are the learned abbreviations that the document holds."""
    rows = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    held = rows.select("doc_id", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"(?<![\p{L}\p{M}\p{N}.])([\p{L}\p{M}]{1,6})\."), F.lit(1)), F.lower))).alias("word"))
    own = held.join(cut(learned_abbreviations(documents)), "word").groupBy("doc_id").agg(F.collect_set("word").alias("learned"))  # bounded by the document's own words
    # one exchange by doc_id serves the distinct rows, the join and the spread over all cores
    n = max(parallelism(documents.sparkSession), partitions(rows))
    return rows.repartition(n, "doc_id").distinct().join(own, "doc_id", "left").select("doc_id", "text", F.coalesce("learned", F.array().cast("array<string>")).alias("learned"))


# Own examples, so that each script is known however small the sample is.
EXAMPLES = (
    "Dr. Lee met Mr. Roe at 9 p.m. on Monday. They left. \"Did it work?\" asked J. B. Roe. It did!\n\nSee Fig. 2 and No. 7, p. 3. (Compare p. 9.) Labels, notes, etc. are kept. Labels, etc. The end … or not. \"Stay.\" She nodded.",
    "It ended (see p. 3). “Fine,” they said. We left (late). Then (at 9 p.m.) it rained. He wrote [a note]. \"No.\" And 'yes'. So?",
    "Am 5. März kam Herr Dr. Roe, z. B. mit Listen usw. Dann ging er. „Wer war das?“ fragte Frau Roe. Version 2.1 war da.",
    "« Qui vient ? » demanda M. Roe. Il note la p. ex. suivante, fig. 3. Fini ! Oui.",
    "—¿Quién firma? —preguntó la Sra. Roe. ¡Nadie! El Sr. Roe se fue. ¿Y ahora? Nada.",
    "См. рис. 2 и табл. 4. Новые цели. «Кто там?» — спросил он. В 2004 г. архивы и т. д. Потом всё.",
    "他说：“我们走吧。现在就走。”，然后离开。“谁？”，她问。增长3.5%。好！真的吗？是。",
    "「誰か。」と彼は言った。版は1.2である（第2章を参照。）。はい！本当か？終わり。",
    "“कौन?” डॉ. रो ने पूछा। मान 2.5 है। ठीक! क्या? हाँ।",
    "سأل د. رو: «من هناك؟»، ثم غادر. النسبة 1.5 هنا. نعم! ماذا؟ لا.",
    "วิธีการดี แบบจำลองชัดเจน มี 13 กลุ่ม ค่าเป็น 5.7 เปอร์เซ็นต์ ใครตรวจ? ทีมงาน",
)


def labelled(text: str, learned: frozenset) -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Training chains of a text: the features of each unit's places and their labels.

    An unpunctuated script's closing marks are stripped from the features and
    kept in the labels.
    """
    chains = []
    for s, e in _units(text):
        places = [p for _, p in _places(text[s:e], learned)]
        gold = [int(_weak_label(p)) for p in places]
        if not places:
            continue
        if places[0]["thai"]:
            bare = [p if p["mark"] == "gap" else p | {"mark": "gap", "closed": False, "before": "any", "space": True} for p in places]
            chains.append(([_features(p) for p in bare], gold))
        chains.append(([_features(p) for p in places], gold))
    return chains


def fit(documents: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on a bounded sample of with_abbreviations(): ``rows`` texts of at most TRAIN_CHARS characters, by the hash of their text.

    Texts are thinned by a hash of their own to about twice as many before the
    first are taken, so that no partition sends more than its share.
    """
    fit_for = documents.where(F.length("text") <= TRAIN_CHARS).select("text", "learned", F.xxhash64("text").alias("h"))
    every = max(1, fit_for.count() // (2 * rows))
    sample = fit_for.where(F.pmod(F.xxhash64("h"), F.lit(every)) == 0).orderBy("h", "text").limit(rows)
    chains = [c for text in EXAMPLES for c in labelled(text, frozenset())]
    for r in sample.collect():
        chains += labelled(r["text"], frozenset(r["learned"]))
    return train(chains)


def agreement(texts: list[tuple[str, str, frozenset]], model: Model) -> dict[str, tuple[float, int]]:
    """language -> (F1 of the model's boundaries against the labels, number of labelled boundaries) of held-out (language, text, learned)."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
    for lang, text, learned in texts:
        for feats, gold in labelled(text, learned):
            for y, z in zip(gold, viterbi(model, feats)):
                counts[lang][0] += y and z
                counts[lang][1] += y
                counts[lang][2] += z
    return {k: (2 * both / (gold + found) if gold + found else 1.0, gold) for k, (both, gold, found) in counts.items()}


def sentences(documents: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, sentence_no, start_pos, end_pos, sentence) of every document."""
    docs = cut(with_abbreviations(documents))
    shared = documents.sparkSession.sparkContext.broadcast(fit(docs, rows))

    @F.pandas_udf("array<struct<start_pos:int,end_pos:int>>")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = shared.value
        cache: dict = {}
        for texts, learned in batches:
            yield pd.Series([[{"start_pos": a, "end_pos": b} for a, b in split(t, model, frozenset(x), cache)] for t, x in zip(texts, learned)])

    return (
        docs.select("doc_id", "text", F.posexplode(found("text", "learned")).alias("at", "s"))
        .select("doc_id", (F.col("at") + 1).alias("sentence_no"), "s.start_pos", "s.end_pos", F.substring("text", F.col("s.start_pos") + 1, F.col("s.end_pos") - F.col("s.start_pos")).alias("sentence"))
    )
