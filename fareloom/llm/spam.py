"""Pages of keywords, links, menus or tags instead of writing.

A text is cut into segments (sentences, lines, blocks of short lines), and each is
measured: share of function words and how many different ones, share of words that
the document repeats far too often (top words and top pairs of words), share of characters in links, hashtags
and anchors, density of separators, and whether the line is one of many copies. All bounds are calibrated per language
over all segments of the corpus, within fixed limits. A document is found when segments that are no
writing make up more than half of its text.

Function words can only be missing where they are known. Whether a text in Latin letters that hardly has any is a list of keywords or writing in some other
language is told by its letters: the frequencies of three letters in a row are counted over all documents that do have the function
words of a language, and a text too unlike all of these is judged by the measures that need no words.

One pass in Python measures; calibration is an aggregation of the measures, whose few figures per language go back to the judging of whole batches of them.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import spread, written

#: Function words; of Korean, which has none apart, the endings and particles of words.
FUNCTION_WORDS = {
    "en": frozenset(
        "the a an of to in on at by for from with without and or but as if when while because so than then that this these those which who what where how why there here "
        "is are was were be been being am has have had do does did can could will would shall should may might must not no nor "
        "i you he she it we they me him her us them my your his its our their mine one some any each every both few more most much many other such own same too very "
        "about above after again around mostly nearly almost against all before below between during into like near off once only out over since through till under until up per yet still just now never always".split()
    ),
    "es": frozenset(
        "el la los las lo un una unos unas de del a al en por para con sin sobre entre desde hasta hacia según y e o u ni pero sino aunque porque como si cuando mientras donde que quien cual "
        "es son era fue ser está están estar hay ha han he hemos había tiene tienen tuvo me te se nos le les mi mis tu tus su sus nuestro nuestra este esta estos estas ese esa eso esto aquel "
        "no ya más menos muy tan también nunca siempre antes después durante tras cada todo toda todos todas otro otra otros otras casi solo aún así alguien algo nada qué cómo yo".split()
    ),
    "ru": frozenset(
        "и в во не на я он она оно они мы вы ты что чтобы с со как а но то по из за к ко у о об от до для без при под над или если же ли бы был была было были быть есть нет это этот эта эти того этого "
        "его её их ему ей им мой моя мне меня нас нам вас вам так также уже ещё только когда где кто который которая которые потом после перед между через всё все весь никто ничего сам себя".split()
    ),
}
#: Languages in Latin letters, told apart from each other by their function words and from all others by their letters.
LATIN = ("en", "es")
_KO_ENDINGS = tuple("은|는|을|를|에|의|로|와|과|도|만|에서|에게|으로|까지|부터|보다|처럼|마다|라고|하고|면|서|며|고|지만|니다|니까|세요|어요|아요|네요|군요|까요|요|다|까|죠".split("|"))
_KO_SHORT = frozenset(e for e in _KO_ENDINGS if len(e) == 1)
_KO_ENDING = regex.compile(rf"\p{{Hangul}}(?:{'|'.join(_KO_ENDINGS)})$")
_HANGUL = regex.compile(r"\p{Hangul}")
_WORD = regex.compile(r"[\p{L}\p{N}]+(?:['’][\p{L}]+)?")
_PLAIN_WORD = re.compile(r"[A-Za-z0-9]+(?:'[A-Za-z]+)?")
_FORMAT = regex.compile(r"\p{Cf}+")
_DOT = r"(?:\.|\[\.\]|\(\.\)|\{\.\}|\s(?:dot|\[dot\]|\(dot\))\s)"
#: No repetition can be entered again at the same place, or goes on past the next opening of its kind, so a text of any length takes time in proportion to it. A name between dots has 63 letters at most.
_LINK = regex.compile(
    r"<a\b[^<>]*+>(?:(?!</?a\b).)*+</a>|!?\[[^\[\]\n]*+\]\([^()\n]*+\)|(?:h(?:tt|xx)ps?:?//|www" + _DOT + r")\S++(?:\s/\s\S++)*"
    r"|(?<![\p{L}\p{N}@-])[a-z0-9][a-z0-9-]{0,62}+(?:" + _DOT + r"[a-z][a-z0-9-]{1,62}+)+(?:\s?/\s?[^\s|]++)*|#[\p{L}\p{N}_]++",
    regex.IGNORECASE | regex.DOTALL,
)
#: What every link has somewhere; most texts have none of it.
_LINK_HINTS = ("<a", "](", "//", "www", "#", "[.]", "(.)", "{.}", " dot", "[dot", "(dot")
_DOTTED = re.compile(r"\.[a-z]")
_TAG = regex.compile(r"<[^<>\n]*+>")
_VERB = regex.compile(r"\p{Hangul}(?:니다|니까|세요|어요|아요|네요|군요|까요|다|요|죠)$")
_QUOTED = regex.compile(r"^(?:[>|]+\s*)+")
_SENTENCE_END = re.compile(r"(?<=[.!?。！？…])[\"'”’)\]]*\s+")
_SEPARATORS = re.compile(r"[|/>»«·•;,=\t→←:*~+]|->|👉")
#: A run of one letter, which is a ruler or a drawn-out word: it counts as three of them. Everything else counts in full.
_RUN = re.compile(r"([^\W\d_])\1{3,}")
#: A line of fewer words that doesn't end as a sentence joins the short lines around it.
SHORT_LINE = 6
_LINK_MARK = "\u0001"
_ENDS = frozenset(".!?。！？…")
#: A word or pair of words is far too frequent from so many times and this share of the document's words.
HOT_TIMES, HOT_WORD, HOT_PAIR = 4, 0.025, 0.03
_EVERY = frozenset().union(*FUNCTION_WORDS.values())
_HIRAGANA = regex.compile(r"\p{Hiragana}")
_JAPANESE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
#: Letters that Cyrillic languages other than Russian use.
_NOT_RUSSIAN = frozenset("іїєґўјљњћђџѓќѕ")

#: 32 classes of letters: 0 is none, 1 to 26 the plain ones, the rest the others of Latin-1, folded.
_LETTER = np.zeros(256, dtype=np.int64)
_LETTER[ord("a") : ord("z") + 1] = np.arange(1, 27)
_LETTER[0xDF:0x100] = 27 + np.arange(0xDF, 0x100) % 5
CODES = 32**3
#: A text has a language from this share of function words and so many words on; its letters tell something from so many codes on.
SHARE_OF_LANGUAGE, LEAST_WORDS, LEAST_CODES = 0.3, 15, 40


@dataclass(frozen=True)
class Bounds:
    """Thresholds. Each bound is calibrated per language: that of function words as ``of_median`` of the median share, within ``low`` and ``high``; the others are at
    least the values given here, and more in a language of which ``known_segments`` and more are known and whose upper tenth comes near them.
    A language's letters are known from ``known_letters`` codes on, and a text is none of its when its letters are ``unlike`` more surprising (in nats each) than the language's own."""

    low: float = 0.12
    high: float = 0.25
    of_median: float = 0.42
    kinds: int = 3
    long_segment: int = 8
    copies: int = 4
    hot_share: float = 0.6
    link_share: float = 0.5
    separators: float = 0.5
    text_share: float = 0.5
    page_words: int = 12
    known_segments: int = 50
    known_letters: int = 20_000
    unlike: float = 2.2


def clean(text: str) -> str:
    """NFKC form without format characters."""
    return text if text.isascii() else _FORMAT.sub("", unicodedata.normalize("NFKC", text))


def _words(text: str) -> list[str]:
    return (_PLAIN_WORD if text.isascii() else _WORD).findall(text)


def segments(text: str) -> list[str]:
    """Sentences of the lines. A line goes on in the next one when it doesn't end as a sentence and the next is quoted
    as well or starts in lower case; lines that are short and no sentences are put together."""
    parts: list[list[str]] = []
    open_quote = False
    for raw in text.splitlines():
        line = raw.strip()
        bare = _QUOTED.sub("", line) if line[:1] in (">", "|") else line
        if not bare:
            open_quote = False
            continue
        last = parts[-1][-1] if parts else ""
        if last and last[-1] not in _ENDS and (open_quote if bare != line else bare[0].islower()) and _LINK_MARK not in last:
            parts[-1].append(bare)
        else:
            parts.append([bare])
        open_quote = bare != line
    lines = [" ".join(p) for p in parts]
    out: list[str] = []
    block: list[str] = []
    for line in lines:
        for part in _SENTENCE_END.split(line):
            if not part:
                continue
            if part.rstrip("\"'”’)]")[-1:] not in _ENDS and len(_words(part)) < SHORT_LINE and _LINK_MARK not in part:
                block.append(part)
                continue
            if block:
                out.append("\n".join(block))
                block = []
            out.append(part)
    if block:
        out.append("\n".join(block))
    return out


def _weight(words: list[str], runs: bool) -> int:
    return sum(len(_RUN.sub(r"\1\1\1", w)) for w in words) if runs else sum(map(len, words))


def _may_have_links(text: str) -> bool:
    low = text.lower()
    return any(h in low for h in _LINK_HINTS) or _DOTTED.search(low) is not None or ("dot" in low and re.search(r"\sdot\s", low) is not None)


def _has_runs(text: str) -> bool:
    """Whether some character stands four times in a row; letters are looked at closer where it does."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    same = codes[1:] == codes[:-1]
    return bool((same[2:] & same[1:-1] & same[:-2]).any()) and _RUN.search(text) is not None


def codes_of(text: str) -> np.ndarray:
    """Three letters in a row as one number each, letters in 32 classes."""
    a = _LETTER[np.frombuffer(text.lower().replace(_LINK_MARK, " ").encode("latin-1", "replace"), dtype=np.uint8)]
    if len(a) < 3:
        return a[:0]
    found = (a[:-2] * 32 + a[1:-1]) * 32 + a[2:]
    return found[found > 0]


def measure(text: str | None) -> list[tuple]:
    """``lang, size, words, function, kinds, hot, linked, links, separators, copies`` of each segment."""
    return _measured(text)[0]


def _measured(text: str | None) -> tuple[list[tuple], str]:
    """The measures, and the text without links and tags."""
    if not text or not text.strip():
        return [], ""
    text = clean(text).replace(_LINK_MARK, " ")
    links: list[int] = []

    def mark(m: regex.Match) -> str:
        links.append(sum(map(str.isalnum, m.group())) or 1)
        return _LINK_MARK

    plain = _LINK.sub(mark, text) if _may_have_links(text) else text
    if "<" in plain:
        plain = _TAG.sub(" ", plain)
    parts = segments(plain)
    spoken = [_words(p.lower()) for p in parts]
    # Numbers are neither function words nor keywords.
    if plain.isascii():
        found = [[w for w in ws if w[0] > "9"] for ws in spoken]
    else:
        found = [[w for w in ws if not w[0].isdigit() or (not w.isascii() and _HANGUL.search(w))] for ws in spoken]
    known = Counter(chain.from_iterable(found))
    total = sum(known.values())
    every = _EVERY
    often = {w: n for w, n in known.items() if n >= HOT_TIMES and w not in every}
    hot = {w for w, n in often.items() if n >= HOT_WORD * total}
    hot_pairs = set()
    if often:  # a frequent pair holds a frequent word
        pairs = Counter(p for ws in found for p in zip(ws, ws[1:], strict=False))
        hot_pairs = {p for p, n in pairs.items() if n >= HOT_TIMES and n >= HOT_PAIR * total and not (p[0] in every and p[1] in every)}
    copies = Counter(parts)
    runs = _has_runs(plain.lower())
    out, at = [], 0
    for part, words, said in zip(parts, found, spoken, strict=True):
        count = linked = 0
        if links:
            count = part.count(_LINK_MARK)
            linked = sum(links[at : at + count])
            at += count
        lang, length, functional, kinds, own = _language(part, words)
        repeated = 0.0
        if hot or hot_pairs:
            inside = [False] * len(words)
            if hot_pairs:
                for i, p in enumerate(zip(words, words[1:], strict=False)):
                    if p in hot_pairs:
                        inside[i] = inside[i + 1] = True
            contents = [(w in hot or x) for w, x in zip(words, inside, strict=True) if w not in own]
            repeated = sum(contents) / len(contents) if contents else 0.0
        out.append((lang, _weight(said, runs) + linked, length, functional, kinds, repeated, linked, count, len(_SEPARATORS.findall(part)), copies[part]))
    return out, plain


def _language(part: str, words: list[str]) -> tuple[str, int, int, int, frozenset[str]]:
    """``lang, words, function, kinds`` of a segment and its function words. In Japanese, which has no blanks, letters count as words, and hiragana, which inflects, as function words."""
    latin = part.isascii()
    if not latin and _HANGUL.search(part):
        functional = [w for w in words if (len(w) > 1 and w[-1] in _KO_SHORT and "\uac00" <= w[-2] <= "\ud7a3") or (w.endswith(_KO_ENDINGS) and _KO_ENDING.search(w))]
        extra = 1 if words and _VERB.search(words[-1]) else 0
        return "ko", len(words), len(functional) + extra, len(set(functional)) + extra, frozenset(functional)
    if words and not latin and 2 * sum(w[0] < "\u0250" for w in words) < len(words):
        letters = _JAPANESE.findall(part)
        if letters and any("\u3040" <= c <= "\u30ff" for c in letters):
            kana = _HIRAGANA.findall(part)
            return "ja", len(letters), len(kana), len(set(kana)), frozenset()
        cyrillic = sum("\u0400" <= w[0] <= "\u04ff" for w in words)
        if 2 * cyrillic > len(words) and _NOT_RUSSIAN.isdisjoint(part.lower()):
            functional = [w for w in words if w in FUNCTION_WORDS["ru"]]
            return "ru", len(words), len(functional), len(set(functional)), FUNCTION_WORDS["ru"]
        # What the function words of other scripts are isn't known, so only links and repetition count.
        return "other", len(words), len(words), len(set(words)), frozenset()
    by = {k: [w for w in words if w in FUNCTION_WORDS[k]] for k in LATIN}
    lang = max(by, key=lambda k: len(by[k]))
    return lang, len(words), len(by[lang]), len(set(by[lang])), FUNCTION_WORDS[lang]


_SEGMENT = "array<struct<lang:string,size:bigint,words:bigint,function:bigint,kinds:bigint,hot:double,linked:bigint,links:bigint,separators:bigint,copies:bigint>>"
_TYPES = [("lang", pa.string()), *((n, pa.int64()) for n in ("size", "words", "function", "kinds")), ("hot", pa.float64()), *((n, pa.int64()) for n in ("linked", "links", "separators", "copies"))]
_MEASURES = f"doc_id bigint, segments {_SEGMENT}, codes array<int>, counted string, letters array<bigint>"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("segments", pa.list_(pa.struct(_TYPES))), ("codes", pa.list_(pa.int32())), ("counted", pa.string()), ("letters", pa.list_(pa.int64()))])


def _spoken_in(found: list[tuple]) -> str | None:
    """The Latin language whose function words a text has, ``""`` where it is in Latin letters and has too few of any, None where that can't be said."""
    latin = [x for x in found if x[0] in LATIN]
    words = sum(x[2] for x in latin)
    if words < LEAST_WORDS or 2 * words < sum(x[2] for x in found):
        return None
    lang, functional = max(((k, sum(x[3] for x in latin if x[0] == k)) for k in LATIN), key=lambda x: x[1])
    return lang if functional >= SHARE_OF_LANGUAGE * words else ""


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = {k: np.zeros(CODES, dtype=np.int64) for k in LATIN}
    for batch in batches:
        offsets, each, codes, own = [0], [], [], {k: [] for k in LATIN}
        for text in batch.column(1).to_pylist():
            found, plain = _measured(text)
            each += found
            offsets.append(len(each))
            lang = _spoken_in(found)
            if lang:
                own[lang].append(plain)
            codes.append(codes_of(plain).astype(np.int32) if lang == "" else None)
        for lang, texts in own.items():
            # Two blanks around each text, so that the counts don't depend on which texts stand side by side.
            letters[lang] += np.bincount(codes_of("  ".join(["", *texts, ""])), minlength=CODES)
        columns = list(zip(*each, strict=True)) if each else [[]] * len(_TYPES)
        structs = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _TYPES, strict=True)], fields=[pa.field(*t) for t in _TYPES])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
        none = pa.nulls(batch.num_rows)
        yield pa.record_batch([batch.column(0), lists, pa.array(codes, pa.list_(pa.int32())), none.cast(pa.string()), none.cast(pa.list_(pa.int64()))], schema=_SCHEMA)
    some = [k for k in LATIN if letters[k].any()]
    if some:
        none = pa.nulls(len(some))
        yield pa.record_batch(
            [none.cast(pa.int64()), none.cast(_SCHEMA.field("segments").type), none.cast(pa.list_(pa.int32())), pa.array(some, pa.string()), pa.array([letters[k] for k in some], pa.list_(pa.int64()))], schema=_SCHEMA
        )


def page_measures(docs: DataFrame) -> DataFrame:
    """``doc_id, segments, codes`` with the measures of each segment of the whole text, and the codes of its letters where it has no language; and, in ``counted`` and ``letters`` of
    rows of their own, the letters of each language in a partition. No row of a large table is shuffled."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(rows).mapInArrow(_measure, _MEASURES)


def letter_models(measures: DataFrame, bounds: Bounds = Bounds()) -> list[tuple[np.ndarray, float]]:
    """Per language known well enough the surprise of each code, and the language's own on average. A few fixed-size rows come to the driver."""
    each = measures.where("counted is not null").select("counted", F.posexplode("letters").alias("code", "n")).where("n > 0")
    summed = each.groupBy("counted", "code").agg(F.sum("n").alias("n")).groupBy("counted").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("n"), F.sum("n").alias("all"))
    models = []
    for r in summed.where(F.col("all") >= bounds.known_letters).collect():
        n = np.zeros(CODES)
        n[r.codes] = r.n
        surprise = -np.log((n + 0.1) / (r["all"] + CODES / 10))
        models.append((surprise, float(n @ surprise / r["all"])))
    return models


def language_bounds(measures: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """``lang, missing, hot, link, separators, copies``: per language the bounds beyond which a segment is no writing."""
    each = measures.select(F.inline("segments")).where("lang <> 'other' and words >= 5")
    linked = F.try_divide(F.col("linked"), F.col("size"))
    values = {"missing": F.when(F.col("linked") * 2 < F.col("size"), F.col("function") / F.col("words")), "hot": F.col("hot"), "link": linked, "separators": F.least(F.col("separators") / F.col("words"), F.lit(9.0)), "copies": F.least(F.col("copies"), F.lit(1000)).cast("double")}
    long = each.select("lang", F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), F.round(v, 2).alias("v")) for k, v in values.items())))).where("v is not null")
    counted = long.groupBy("lang", "kind", "v").agg(F.count("*").alias("n"))
    at = lambda kind, share: F.percentile(F.when(F.col("kind") == kind, F.col("v")), F.lit(share), F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    enough = F.sum(F.when(F.col("kind") == "copies", F.col("n"))) >= bounds.known_segments
    upper = lambda kind, least, times, most: F.when(enough, F.least(F.lit(most), F.greatest(F.lit(least), F.coalesce(at(kind, 0.9), F.lit(0.0)) * times))).otherwise(F.lit(least)).alias(kind)
    return counted.groupBy("lang").agg(
        F.least(F.lit(bounds.high), F.greatest(F.lit(bounds.low), F.coalesce(at("missing", 0.5), F.lit(0.0)) * bounds.of_median)).alias("missing"),
        upper("hot", bounds.hot_share, 1.5, 0.9), upper("link", bounds.link_share, 1.5, 0.9), upper("separators", bounds.separators, 1.5, 2.0), upper("copies", float(bounds.copies), 2.0, 1000.0),
    )


def spam_shares(docs: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """``doc_id, size, share, words, links, spam`` of every document; ``size`` counts letters and digits (of a run of one letter three), ``share`` of them are no writing.

    Null, empty and blank texts have size 0 and are never spam. A text of fewer than ``page_words`` words (a link
    counts as two) is spam by links, separators, repetition or copies, not for want of function words: a bare title is no page. Repeated rows are judged each. Segments in a script
    that is neither Latin, Hangul, Russian nor Japanese, and texts in Latin letters unlike those of any language the corpus has enough of, are judged by links, separators and repetition alone. Other columns are not read.
    """
    measures = written(page_measures(docs), "measures")
    texts = measures.where("counted is null")
    by_lang = {r.lang: r.asDict() for r in language_bounds(texts, bounds).collect()}
    judged = texts.select("doc_id", "segments", "codes").mapInArrow(_judge(by_lang, letter_models(measures, bounds), bounds), "doc_id bigint, size bigint, share double, words bigint")
    return judged.withColumn("spam", F.col("share") > bounds.text_share)


def _judge(by_lang: dict[str, dict], models: list[tuple[np.ndarray, float]], bounds: Bounds):
    """Measures to shares, all segments of a batch at once."""
    fixed = {"missing": bounds.low, "hot": bounds.hot_share, "link": bounds.link_share, "separators": bounds.separators, "copies": float(bounds.copies)}
    langs = [*LATIN, "ko", "ru", "ja", "other"]
    limits = {k: np.array([by_lang.get(lang, fixed)[k] for lang in langs]) for k in fixed}

    def unlike(codes: np.ndarray) -> bool:
        """Whether the letters are more surprising in every known language than its own are."""
        return len(codes) >= LEAST_CODES and all(surprise[codes].mean() - own > bounds.unlike for surprise, own in models)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, codes = batch.column(1), batch.column(2)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            lang = pc.index_in(flat.field("lang"), pa.array(langs)).to_numpy(zero_copy_only=False).astype(np.int64)
            x = {name: flat.field(name).to_numpy(zero_copy_only=False) for name, _ in _TYPES[1:]}
            limit = {k: v[lang] for k, v in limits.items()}
            odd = np.zeros(batch.num_rows, dtype=bool)
            for i in np.flatnonzero(codes.is_valid().to_numpy(zero_copy_only=False)):
                odd[i] = unlike(codes[int(i)].values.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            wordless = odd[of] & (lang < len(LATIN))
            words, few = x["words"], (x["kinds"] < bounds.kinds) | wordless
            linked = x["linked"] >= x["size"] * limit["link"]
            missing = x["function"] < words * limit["missing"]
            uniform = (words >= bounds.long_segment) & (x["kinds"] < np.where(words >= 2 * bounds.long_segment, bounds.kinds, bounds.kinds - 1))
            listed = (x["separators"] >= words * limit["separators"]) & (few | (lang == langs.index("other")))
            repeated = ((words >= bounds.long_segment) | (x["copies"] > 1)) & (x["hot"] >= limit["hot"])
            copied = (x["copies"] >= limit["copies"]) & ((x["function"] < words * limit["missing"] * 1.5) | wordless)
            surely = linked | repeated | copied
            junk = surely | listed | ((missing | uniform) & ~wordless)
            # In a text too short for a page any repetition is one, but words aren't missing.
            surely = surely | (listed & (words + x["links"] > 1)) | ((words >= bounds.copies) & (x["hot"] >= limit["hot"]))
            total = lambda v: np.bincount(of, weights=v, minlength=batch.num_rows)  # noqa: B023, E731
            size, count = total(x["size"]), total(words + 2 * x["links"])
            part = np.where(count >= bounds.page_words, total(x["size"] * junk), total(x["size"] * surely))
            share = np.divide(part, size, out=np.zeros(batch.num_rows), where=size > 0)
            yield pa.record_batch([batch.column(0), pa.array(size.astype(np.int64)), pa.array(share), pa.array(count.astype(np.int64))], names=["doc_id", "size", "share", "words"])

    return judge
