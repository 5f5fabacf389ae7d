"""Native text columns: cleaning, tokens, n-grams, legal forms and address parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at the ends; trim() takes blanks alone."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def tokens(c: Column, first: int | None = None) -> Column:
    """Words between white space; the ``first`` of them alone without a search of the rest."""
    if first is None:
        return F.filter(F.split(c, r"\s+"), lambda x: x != "")
    return F.slice(F.filter(F.split(c, r"\s+", first + 2), lambda x: x != ""), 1, first)  # an empty one may lead, the rest is last


def ngrams(c: Column, n: int = 3) -> Column:
    """Distinct character n-grams of the lower-cased text, blanks included; none if it is shorter."""
    return F.array_distinct(all_ngrams(c, n))


def all_ngrams(c: Column, n: int = 3) -> Column:
    """As ngrams(), with repetition; one pass over the text, since substring() counts from its start."""
    low = F.lower(c)
    each = F.regexp_extract_all(low, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))
    return F.when(F.length(low) >= n, each).otherwise(F.array().cast("array<string>"))


#: Blocks of the scripts that are transliterated, in order of preference.
SCRIPTS = {
    "Devanagari": r"[ऀ-ॿ]", "Bengali": r"[ঀ-৿]", "Gurmukhi": r"[਀-੿]", "Gujarati": r"[઀-૿]", "Oriya": r"[଀-୿]",
    "Tamil": r"[஀-௿]", "Telugu": r"[ఀ-౿]", "Kannada": r"[ಀ-೿]", "Malayalam": r"[ഀ-ൿ]", "Sinhala": r"[඀-෿]",
    "Tibetan": r"[ༀ-࿿]",
}


def script(c: Column) -> Column:
    """The first script of SCRIPTS that stands anywhere in the text, else Latin."""
    return reduce(lambda rest, kv: F.when(c.rlike(kv[1]), F.lit(kv[0])).otherwise(rest), reversed(SCRIPTS.items()), F.lit("Latin"))


#: Postal codes by country.
POSTAL = {"India": r"\b\d{6}\b", "US": r"\b\d{5}(?:-\d{4})?\b", "France": r"\b\d{5}\b"}


def postal_codes(addr: Column, country: Column) -> Column:
    """All codes in order, repeats kept; none for a country without a pattern."""
    none = F.array().cast("array<string>")
    return reduce(lambda rest, kv: F.when(country == kv[0], F.regexp_extract_all(addr, F.lit(kv[1]), F.lit(0))).otherwise(rest), POSTAL.items(), none)


#: The cues before parts of an address, and street words.
HOUSE = r"(?i)\b(?:h\.?no\.?|house\s+no\.?|door\s+no\.?|plot\s+no\.?|building\s+no\.?|flat\s+no\.?|unit\s+no\.?)\.?\s*[:\-]?\s*([A-Z0-9\-/]+)"
STREET = (
    r"(?i)\b(?:road|street|avenue|drive|lane|boulevard|circle|court|place|highway|parkway|rd|st|ave|dr|ln|blvd|cir|ct|pl|hwy|pkwy)\.?\b"
)
UNIT = r"(?i)\b(?:unit|flat|apartment|apt|suite|ste|floor|fl|level)\.?\s*[:\-]?\s*([A-Z0-9\-/]+)"
PO_BOX = r"(?i)\b(?:p\.?o\.?\s*box|post\s*office\s*box)\.?\s*[:\-]?\s*(\d+)"
BEFORE, AFTER = 50, 20


def house_number(addr: Column) -> Column:
    return F.regexp_extract(addr, HOUSE, 1)


def unit(addr: Column) -> Column:
    return F.regexp_extract(addr, UNIT, 1)


def po_box(addr: Column) -> Column:
    return F.regexp_extract(addr, PO_BOX, 1)


def road(addr: Column) -> Column:
    """The text around the first street word."""
    at, word = F.regexp_instr(addr, F.lit(STREET)), F.regexp_extract(addr, STREET, 0)
    begin = F.greatest(F.lit(1), at - BEFORE)
    return F.when(at > 0, strip(F.substring(addr, begin, at + F.length(word) + AFTER - begin))).otherwise(F.lit(""))


def house_number_norm(number: Column) -> Column:
    """Leading digits, or else the lower-cased text."""
    n = strip(safe(number))
    return F.when(n.rlike(r"^\d+"), F.regexp_extract(n, r"^(\d+)", 1)).otherwise(F.lower(n))


#: Legal forms that end names.
LEGAL_FORMS = [
    "incorporated", "inc", "corporation", "corp", "company", "co", "limited", "ltd", "llc", "l.l.c", "lc", "llp", "l.l.p", "lp", "l.p", "pllc", "p.l.l.c", "pc", "p.c", "pa", "p.a",
    "plc", "pvt", "private", "pty", "gmbh", "ag", "kg", "ohg", "ug", "e.v", "sarl", "s.a.r.l", "sas", "s.a.s", "sa", "s.a", "eurl", "sci", "snc", "scop", "bv", "b.v", "nv", "n.v",
    "srl", "s.r.l", "spa", "s.p.a", "sl", "s.l", "oy", "ab", "a/s", "as", "kk", "opc",
]


def basename(name: Column) -> Column:
    """A name without the legal forms at its end, however many, and the punctuation they leave."""
    forms = "|".join(f.replace(".", r"\.") for f in sorted(LEGAL_FORMS, key=lambda f: (-len(f), f)))
    bare = F.regexp_replace(name, rf"(?i)(?:[\s,]+\(?(?:{forms})\.?\)?)+[\s,.]*$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"[\s,]+$", ""), r"\s+", " ")


#: Pattern -> canonical legal form, by country, in order.
CANONICAL = {
    "US": [
        (r"\bllc\.?\b", "LLC"), (r"\bl\.l\.c\.?\b", "LLC"), (r"\blc\.?\b", "LLC"), (r"\binc\.?\b", "Inc"), (r"\bincorporated\b", "Inc"), (r"\bcorp\.?\b", "Corp"),
        (r"\bcorporation\b", "Corp"), (r"\bltd\.?\b", "Ltd"), (r"\blimited\b", "Ltd"), (r"\blp\.?\b", "LP"), (r"\bl\.l\.p\.?\b", "LLP"), (r"\bllp\b", "LLP"), (r"\bpllc\b", "PLLC"),
        (r"\bp\.l\.l\.c\.?\b", "PLLC"), (r"\bpc\.?\b", "PC"), (r"\bp\.c\.?\b", "PC"), (r"\bpa\.?\b", "PA"), (r"\bco\.?\b", "Co"), (r"\bcompany\b", "Co"), (r"\bgroup\b", "Group"),
        (r"\bassociates\b", "Associates"), (r"\bpartners\b", "Partners"), (r"\bholdings\b", "Holdings"), (r"\btrust\b", "Trust"), (r"\bfoundation\b", "Foundation"), (r"\bsociety\b", "Society"),
    ],
    "India": [
        (r"\bpvt\.?\s*ltd\.?\b", "Pvt Ltd"), (r"\bprivate\s+limited\b", "Pvt Ltd"), (r"\bpvt\s+ltd\b", "Pvt Ltd"), (r"\bprivate\s+ltd\b", "Pvt Ltd"), (r"\blimited\b", "Limited"),
        (r"\bltd\.?\b", "Ltd"), (r"\bllp\b", "LLP"), (r"\bl\.l\.p\.?\b", "LLP"), (r"\bprivate\s+company\b", "Pvt Ltd"), (r"\bpvt\s+company\b", "Pvt Ltd"),
        (r"\bpublic\s+limited\b", "Public Ltd"), (r"\bpub\s+ltd\b", "Public Ltd"), (r"\btrust\b", "Trust"), (r"\bfoundation\b", "Foundation"), (r"\bsociety\b", "Society"),
        (r"\bco-operative\b", "Co-operative"), (r"\bcooperative\b", "Co-operative"), (r"\bgovt\.?\b", "Govt"), (r"\bgovernment\b", "Govt"),
    ],
}


def canonical_suffix(name: Column, country: Column) -> Column:
    """Legal forms in their canonical spelling; names of other countries stay as they are."""
    out = name
    for where, rules in CANONICAL.items():
        out = F.when(country == where, reduce(lambda c, r: F.regexp_replace(c, "(?i)" + r[0], r[1]), rules, name)).otherwise(out)
    return out


#: Subdivision names and codes.
STATES = {
    "US": "Alabama AL,Alaska AK,Arizona AZ,Arkansas AR,California CA,Colorado CO,Connecticut CT,Delaware DE,District of Columbia DC,Florida FL,Georgia GA,Hawaii HI,Idaho ID,Illinois IL,"
    "Indiana IN,Iowa IA,Kansas KS,Kentucky KY,Louisiana LA,Maine ME,Maryland MD,Massachusetts MA,Michigan MI,Minnesota MN,Mississippi MS,Missouri MO,Montana MT,Nebraska NE,Nevada NV,"
    "New Hampshire NH,New Jersey NJ,New Mexico NM,New York NY,North Carolina NC,North Dakota ND,Ohio OH,Oklahoma OK,Oregon OR,Pennsylvania PA,Puerto Rico PR,Rhode Island RI,"
    "South Carolina SC,South Dakota SD,Tennessee TN,Texas TX,Utah UT,Vermont VT,Virginia VA,Washington WA,West Virginia WV,Wisconsin WI,Wyoming WY",
    "India": "Andaman and Nicobar Islands AN,Andhra Pradesh AP,Arunachal Pradesh AR,Assam AS,Bihar BR,Chandigarh CH,Chhattisgarh CG,Delhi DL,Goa GA,Gujarat GJ,Haryana HR,Himachal Pradesh HP,"
    "Jammu and Kashmir JK,Jharkhand JH,Karnataka KA,Kerala KL,Ladakh LA,Lakshadweep LD,Madhya Pradesh MP,Maharashtra MH,Manipur MN,Meghalaya ML,Mizoram MZ,Nagaland NL,Odisha OD,Puducherry PY,"
    "Punjab PB,Rajasthan RJ,Sikkim SK,Tamil Nadu TN,Telangana TS,Tripura TR,Uttar Pradesh UP,Uttarakhand UK,West Bengal WB",
    "France": "Auvergne-Rhone-Alpes ARA,Bourgogne-Franche-Comte BFC,Bretagne BRE,Centre-Val de Loire CVL,Corse 20R,Grand-Est GES,Hauts-de-France HDF,Ile-de-France IDF,Normandie NOR,"
    "Nouvelle-Aquitaine NAQ,Occitanie OCC,Pays-de-la-Loire PDL,Provence-Alpes-Cote-d'Azur PAC",
}


def states() -> dict[str, list[tuple[str, str]]]:
    """Country -> (lower-case name, code), the longest names first, ties by code."""
    parts = {c: [x.rsplit(" ", 1) for x in s.split(",")] for c, s in STATES.items()}
    return {c: sorted(((n.lower(), code) for n, code in p), key=lambda x: (-len(x[0]), x[1])) for c, p in parts.items()}


def _first_in(addr: Column, names: list[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(F.contains(addr, F.lit(n)), F.lit(v)) for n, v in names], F.lit(""))


def state(addr: Column, country: Column) -> Column:
    """The code of the longest subdivision name that stands in a lower-case address."""
    out = F.lit("")
    for where, names in states().items():
        out = F.when(country == where, _first_in(addr, names)).otherwise(out)
    return out


def city(addr: Column, cities: list[str]) -> Column:
    """The city of a gazetteer that stands first in an address, whatever the case; the longest of those."""
    if not cities:
        return F.lit("")
    words = "|".join(sorted({c.lower().replace(".", r"\.") for c in cities}, key=lambda c: (-len(c), c)))
    return F.regexp_extract(F.lower(addr), rf"\b({words})\b", 1)
