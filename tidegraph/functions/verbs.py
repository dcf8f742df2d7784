"""Forms of the verbs in relation names, and the map from forms to canonical names.

A base is found by inflecting: of the words that a form may come from, one counts whose own
forms hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

# Pasts that are not regular, verbs of several syllables that double their last letter, and words that end a verb.
IRREGULAR = {
    "BEGIN": "BEGAN", "BIND": "BOUND", "BRING": "BROUGHT", "BUILD": "BUILT", "BUY": "BOUGHT", "CHOOSE": "CHOSE", "COME": "CAME", "CUT": "CUT", "DRIVE": "DROVE", "FIND": "FOUND", "GET": "GOT", "GIVE": "GAVE", "GROW": "GREW", "HOLD": "HELD", "KEEP": "KEPT", "LEAD": "LED",
    "LEND": "LENT", "LOSE": "LOST", "MAKE": "MADE", "MEET": "MET", "PUT": "PUT", "RUN": "RAN", "SEE": "SAW", "SELL": "SOLD", "SEND": "SENT", "SET": "SET", "SPEND": "SPENT", "TAKE": "TOOK", "TELL": "TOLD", "THINK": "THOUGHT", "WIN": "WON", "WRITE": "WROTE",
}
DOUBLING = {"BEGIN", "ADMIT", "COMMIT", "PERMIT", "SUBMIT", "TRANSMIT", "OCCUR", "REFER", "PREFER", "TRANSFER", "INFER", "CONTROL", "COMPEL"}
PREPOSITIONS = {"WITH", "BY", "ON", "IN", "TO", "FOR", "FROM", "OF", "AT"}
VOWELS = set("AEIOU")
#: Ends of stems that a silent E was taken from.
SILENT = ("AT", "AC", "NC", "RC", "UC", "IC", "IZ", "YZ", "V", "UR", "IR", "AR", "UT", "ID", "AD", "UD", "AS", "IS", "OS", "US", "RS", "LS", "DG", "RG", "AG", "IN", "UN", "IT", "IL", "AK", "OK", "OP", "BL", "PL", "TL")
#: Two letters for one vowel: what follows them ends a word without E.
PAIRS = {"AI", "EA", "EE", "EI", "OA", "OI", "OO", "OU"}


def _syllables(word: str) -> int:
    """Stretches of vowels, Y behind a consonant among them."""
    kinds = [c in VOWELS or (c == "Y" and i > 0) for i, c in enumerate(word)]
    return sum(k and not (i and kinds[i - 1]) for i, k in enumerate(kinds))


def _doubles(base: str) -> bool:
    short = len(base) > 2 and base[-1] not in VOWELS | set("HWXY") and base[-2] in VOWELS and base[-3] not in VOWELS
    return base in DOUBLING or (short and _syllables(base) == 1)


def forms(base: str) -> dict[str, str]:
    """The base, past, gerund and third person of a verb in capitals."""
    soft = base[-1:] == "Y" and base[-2:-1] not in VOWELS and len(base) > 1
    stem = base + base[-1] if _doubles(base) else base
    past = base + "D" if base.endswith("E") else base[:-1] + "IED" if soft else stem + "ED"
    gerund = base[:-2] + "YING" if base.endswith("IE") else base[:-1] + "ING" if base.endswith("E") and not base.endswith(("EE", "YE", "OE")) else stem + "ING"
    third = base + "ES" if base.endswith(("S", "SH", "CH", "X", "Z")) else base[:-1] + "IES" if soft else base + "S"
    return {"base": base, "past": IRREGULAR.get(base, past), "gerund": gerund, "third": third}


def base_of(word: str) -> str:
    """The base of a form; a word that is no form of another is its own base."""
    for base, past in IRREGULAR.items():
        if word in (past, *forms(base).values()):
            return base
    stems = []
    for end, adds in (("IES", ("Y", "IE")), ("ES", ("", "E")), ("S", ("",)), ("IED", ("Y", "IE")), ("ED", ("", "E")), ("YING", ("Y", "IE")), ("ING", ("", "E"))):
        cut = word[: -len(end)]
        if word.endswith(end) and (_syllables(cut) or end in ("IES", "IED", "YING")) and not (end == "S" and word.endswith(("SS", "US", "IS"))):
            if cut[-1:] == cut[-2:-1] and (cut[-1] not in "LSFZ" or cut[:-1] in DOUBLING):
                stems.append(cut[:-1])
            stems += [cut + add for add in (adds if len(cut) > 1 else adds[::-1])]
    fit = [s for s in dict.fromkeys(stems) if len(s) > 1 and s[-1] != "I" and _syllables(s) and word in forms(s).values()]
    # where a stem fits with E and without, one that English words don't end in had it
    silent = [s for s in fit if s.endswith("E") and s[:-1] in fit and s[:-1].endswith(SILENT) and (s[-4:-2] not in PAIRS or s == "CREATE")]
    plain = [s for s in fit if not (s.endswith("E") and s[:-1] in fit)]
    return (silent or plain or fit or [word])[0]


def variants(name: str) -> list[tuple[str, str]]:
    """(variant, form) of a relation name: its first word as a verb in all forms, the rest as it is; and the name turned round
    by _BY, where it has no preposition. The name itself is left out."""
    verb, *rest = name.split("_")
    out = [("_".join([word, *rest]), form) for form, word in forms(base_of(verb)).items()] if verb else []
    if not PREPOSITIONS & set(rest):
        out.append((f"{name}_BY", "inverse"))
    return [(v, f) for v, f in out if v != name]


@udtf(returnType="variant string, form string")
class VerbForms:
    def eval(self, name: str):
        yield from variants(name or "")


def normalization_map(names: DataFrame) -> DataFrame:
    """(variant, form, canonical) of canonical relation names (rel, capitals and underscores).

    A variant that is a canonical name itself is left out; one that several names have goes to
    the first of them. Nulls, blanks and repeats of names count for nothing.
    """
    n = names.select(F.upper(F.trim("rel")).alias("canonical")).where("canonical <> ''").distinct()
    made = n.lateralJoin(VerbForms(F.col("canonical").outer())).join(n.select(F.col("canonical").alias("variant")), "variant", "left_anti")
    return made.groupBy("variant").agg(F.min(F.struct("canonical", "form")).alias("m")).select("variant", "m.form", "m.canonical")


def coverage(said: DataFrame, names: DataFrame, known: DataFrame) -> DataFrame:
    """(class, n, forms) of relation names as models write them (rel): canonical, normalized by the map, or unknown.

    known: a map (variant, canonical). Names are compared in capitals, those not found once more with - and blanks as _.
    """
    counted = said.select(F.upper("rel").alias("up")).groupBy("up").agg(F.count("*").alias("n"))  # as many rows as spellings
    canonical = names.select(F.upper("rel").alias("up"), F.lit(True).alias("is_canonical")).distinct()
    plain, snake = (known.select(F.col("variant").alias(c), F.lit(True).alias(f"by_{c}")) for c in ("up", "snake"))
    x = counted.withColumn("snake", F.regexp_replace("up", "[- ]", "_")).join(canonical, "up", "left").join(plain, "up", "left").join(snake, "snake", "left")
    kind = F.when(F.col("is_canonical"), "canonical").when(F.coalesce("by_up", "by_snake"), "normalized").otherwise("unknown")
    return x.groupBy(kind.alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("forms"))
