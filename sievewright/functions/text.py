"""Text functions: mark-up, names, paths and captions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions import let
from sievewright.schema import PLASTIC, PROXY, STRATA, SYNTHETIC

# Fixed values of the captions.
NOISE = r"(\b\d{1,2}:\d{2}\b|\bDSC[_-]?\d+|\bIMG[_-]?\d+|\bcamera\b|\bnikon\b|\bcanon\b|\bwikimedia\b|\bcommons\b|\bown work\b|\bself-photographed\b|\buploaded\b|\bcc[- ]by[- ]sa\b|\bpublic domain\b|\bhttps?://\S+)"
CATEGORY_TAGS = {
    "sandstone": "sandstone",
    "limestone": "limestone",
    "shale": "shale",
    "mudstone": "mudstone",
    "conglomerate": "conglomerate",
    "breccia": "breccia",
    "cross-bedding": "cross-bedded",
    "bedding": "horizontal bedding",
    "strata": "layered strata",
    "stratigraphy": "stratigraphic section",
    "outcrop": "rock outcrop",
    "cliff": "cliff face",
    "fold": "folded strata",
    "unconformit": "unconformity",
    "slag": "vitrified slag",
    "ignimbrite": "ignimbrite",
    "volcanic": "volcanic rock",
    "fulgurite": "fulgurite",
    "plastiglomerate": "fused plastic and sediment",
    "marine debris": "marine debris",
    "plastic": "embedded plastic fragments",
}
PANORAMIC_FRAME, CLOSE_FRAME = "wide panoramic section", "close detail"
DESATURATED_BELOW, DESATURATED = 18.0, "desaturated grey tones"
SPECIMEN_WORDS = ("specimen",)
MUSEUM_WORDS = ("museum", "museo", "博物館", "vitrine", "vitrina", "display case")
SPECIMEN_NOTE = "descripción menciona 'specimen': revisar si es foto de estudio"
MUSEUM_NOTE = "nombre menciona museo/vitrina: revisar si es foto de estudio"


@dataclass(frozen=True)
class CaptionWords:
    """The project's own words of a caption: the trigger token, and the token of generated pictures."""

    trigger: str = "geo_concept"
    synthetic: str = "geo_synth"

    def hint(self, klass: Column) -> Column:
        """What the caption says of a class; null where there is nothing to say."""
        out = F.when(klass == STRATA, "sedimentary strata").when(klass == PLASTIC, "plastiglomerate").when(klass == PROXY, "fused industrial conglomerate")
        return out.when(klass == SYNTHETIC, f"{self.synthetic}, plastiglomerate")


def parsed(c: Column, schema: str) -> Column:
    """A JSON text as a struct; fields it lacks are null, and so is all of a text that is no JSON."""
    return F.from_json(c, schema)


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def html_strip(c: Column) -> Column:
    """Text without tags, white space collapsed; null if nothing is left.  Entities stay."""
    return none_if_empty(F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"(?U)\s+", " ")))


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def safe_filename(c: Column) -> Column:
    """Runs of anything but letters, digits, ``_``, ``.`` and ``-`` become one ``_``; outer ones go; lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_.-]+", "_"), "^_+|_+$", ""))


def suffix(name: Column) -> Column:
    """The last dot and what follows, lower case; '' if there is none or the dot leads."""
    return F.lower(F.regexp_extract(name, r"[^/.][^/]*?(\.[^./]+)$", 1))


def stem(name: Column) -> Column:
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.when(F.regexp_like(base, F.lit(r"^.+\.[^.]+$")), F.regexp_replace(base, r"\.[^.]+$", "")).otherwise(base)


#: One of these stands, lower-cased, in every text that has noise: the words that ``NOISE`` asks for.
NOISE_NEEDS = (":", "dsc", "img", "camera", "nikon", "canon", "wikimedia", "commons", "own work", "self-photographed", "uploaded", "cc-by", "cc by", "public domain")
#: Letters that match an ASCII letter of another case without becoming one in lower case.
FOLDED = ("\u017f", "\u212a", "\u0130", "\u0131")


def may_have_noise(c: Column) -> Column:
    """False only where ``NOISE`` cannot match: a few searches for words spare most texts the pattern."""
    low = let(F.lower(c), lambda low: reduce(or_, [F.contains(low, F.lit(w)) for w in NOISE_NEEDS]))
    return low | reduce(or_, [F.contains(c, F.lit(x)) for x in FOLDED])


def clean(c: Column) -> Column:
    """A description without noise and odd characters, white space collapsed, outer `` ,.-`` stripped."""
    text = F.coalesce(c, F.lit(""))
    text = F.when(may_have_noise(text), F.regexp_replace(text, "(?iU)" + NOISE, " ")).otherwise(text)
    # odd characters and white space become one space together
    return F.btrim(F.regexp_replace(text, r"[^\p{L}\p{N}_,.-]+", " "), F.lit(" ,.-"))


def first_sentence(cleaned: Column) -> Column:
    """Up to the first stop, lower case without the stop; null unless it has 2 to 22 words."""

    def kept(first: Column) -> Column:
        return F.when((first != "") & F.size(F.split(first, " ")).between(2, 22), F.regexp_replace(F.lower(first), r"\.+$", ""))

    return let(F.split(cleaned, r"(?<=[.;])\s+", 2)[0], kept)


def category_tags(categories: Column, most: int = 6) -> Column:
    """Tags whose needle stands anywhere in the joined categories, in the table's order."""
    found = let(F.lower(F.array_join(categories, " ")), lambda joined: F.array(*[F.when(F.contains(joined, F.lit(n)), t) for n, t in CATEGORY_TAGS.items()]))
    return F.slice(F.array_distinct(F.array_compact(found)), 1, most)


def distinct_parts(parts: Column) -> Column:
    """Without nulls and blanks, each part once whatever its case, in the first spelling."""
    kept = F.filter(F.transform(F.array_compact(parts), lambda x: F.trim(x)), lambda x: x != "")
    both = F.transform(kept, lambda x: F.struct(x.alias("part"), F.lower(x).alias("key")))
    # a part is new if its key stands in none of the parts before it
    return let(both, lambda b: let(F.transform(b, lambda p: p["key"]), lambda keys: F.transform(F.filter(b, lambda p, i: F.array_position(keys, p["key"]) == i + 1), lambda p: p["part"])))


def caption(klass: Column, categories: Column, description: Column, saturation: Column, panoramic: Column, words: CaptionWords = CaptionWords()) -> Column:
    """The caption of a record, a comma-separated list of parts."""
    head = F.array(F.lit(words.trigger), words.hint(klass))
    tail = F.array(first_sentence(clean(description)), F.when(saturation < DESATURATED_BELOW, DESATURATED), F.when(panoramic, PANORAMIC_FRAME).otherwise(CLOSE_FRAME))
    return F.array_join(distinct_parts(F.concat(head, category_tags(F.coalesce(categories, F.array().cast("array<string>"))), tail)), ", ")


def mentions(text: Column, words: tuple[str, ...]) -> Column:

    def any_of(low: Column) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | F.contains(low, F.lit(w))
        return out

    return let(F.lower(F.coalesce(text, F.lit(""))), any_of)
