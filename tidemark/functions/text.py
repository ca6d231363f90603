"""Scalar functions over text columns: labels, dates, periods, addresses, titles. All of them are Catalyst expressions.

Patterns are java.util.regex, as Spark's. Java's \\s is ASCII, so other blanks are named where they count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms that notices use.
DOTS = "ㆍ⋅∙•․‧・･"
BULLET = r"[-–—·o○]"
LABEL_BULLET = r"[-–—·o○□※◦▷◎▪]"
ENUMERATOR = r"(?:\d{1,2}\s*[.)]|[가-힣]\s*[.)]|[①-⑳㉮-㉻])"
LABEL_LINE = rf"^\s*(?:{BULLET}\s*)?{ENUMERATOR}?\s*([^:：]{{1,40}}?)\s*[:：]\s*(.*)$"
LINE_NUMBER = rf"^\s*(?:{BULLET}\s*)?(\d{{1,2}})\s*[.)]"
#: White space as the loader counts it: without no-break spaces.
SPACES = r"\s\x1C-\x1F\u1680\u2000-\u2006\u2008-\u200A\u2028\u2029\u205F\u3000"
BLANK = r"[\s\u00A0\u3000]+"
#: The characters that trimming takes away.
CONTROL = "".join(map(chr, range(0x20, -1, -1)))
DATE_KOREAN = r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일"
DATE_NUMERIC = r"(\d{4})\s*[.\-/]\s*(\d{1,2})\s*[.\-/]\s*(\d{1,2})\s*\.?"
DATE_SHORT = r"[’'`]\s*(\d{2})\s*[.\-/]\s*(\d{1,2})\s*[.\-/]\s*(\d{1,2})\s*\.?"
RANGE_MARK = r"\s*(?:[~～∼–—]|부터)\s*"
SIDO = r"(?:[가-힣]{2,8}(?:특별시|광역시|특별자치시|특별자치도)|[가-힣]{2,8}도|서울|부산|대구|인천|광주|대전|울산|세종)"
ROAD = r"[가-힣A-Za-z0-9]+(?:로|길)\s*\d+(?:-\d+)?(?:번길\s*\d+)?"
LOT = r"[가-힣0-9]+(?:동|리|가|읍|면)\s*산?\s*\d+(?:-\d+)?(?:번지)?(?:\s*일원| 인근)?"
ADDRESS = rf"(?:{SIDO}\s*)?[가-힣]{{1,10}}(?:시|군|구)(?:\s+[가-힣]{{1,10}}(?:읍|면|구))?\s+(?:{ROAD}|{LOT})(?:\s*,?\s*[가-힣0-9\s]{{0,20}}(?:층|호|번지))?"
CAPTION = r"^\s*[<\[]?\s*(?:표|Table|그림|Figure|Fig\.?|사진)\s*[\d一-龥]*\s*[>\]]?"
SERIAL = r"제\s*[\d一-龥]+(?:\s*[-–—]\s*[\d一-龥]*)?\s*호"
NOTICE_WORD = r"(?:고\s*시|공\s*고)"
NOTICE_LINE = rf"^\s*(\S.*?)??\s*({NOTICE_WORD}\s*{SERIAL})\s*$"
NOTICE_HEADER = r"^\s*(고\s*시|공\s*고)\s*문\s*(?:[(（]\s*안\s*[)）])?\s*$"
BARE_SERIAL = rf"^\s*(\S.*?)\s*({SERIAL})\s*$"
#: What every date has.
DATE_MARK = r"\d\s*[년.\-/]\s*\d"
SIGNER = r"^[가-힣·\s]{2,30}(청장|시장|군수|구청장|도지사|지사|본부장|장관|사업소장|소장)$"
STATUTE = r"공유수면관리및매립에관한법[률령]"
#: Longest label that is kept though no item knows it, in UTF-16 units.
MAX_LABEL = 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_control(c: Column | str) -> Column:
    """Without the characters up to U+0020 at both ends."""
    return F.btrim(_col(c), F.lit(CONTROL))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")).rlike(f"^[{SPACES}]*$")


def group(c: Column | str, pattern: str, n: int) -> Column:
    """A group of the first match, null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(_col(c), F.lit(pattern) if not isinstance(pattern, str) else pattern, n), F.lit(""))


def utf16_length(c: Column | str) -> Column:
    return F.length(_col(c)) + F.length(F.regexp_replace(_col(c), r"[^\x{10000}-\x{10FFFF}]", ""))


def _composed(c: Column) -> Column:
    """Unicode's composed form, the one thing here that Spark has no function for."""
    import unicodedata

    @F.pandas_udf("string")
    def compose(s):
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return compose(c)


def normalise_label(c: Column | str, compose: bool = False) -> Column:
    """The form in which labels are looked up: no enumeration, no blanks, one kind of middle dot, no colon at the end.

    With compose, texts that hold combining marks or lone jamo are composed first, in Arrow batches.
    """
    text = _col(c)
    if compose:
        text = F.when(text.rlike(r"[\u0300-\u036F\u1100-\u11FF]"), _composed(text)).otherwise(text)
    text = F.translate(trim_control(F.coalesce(text, F.lit(""))), DOTS, "·" * len(DOTS))
    text = F.regexp_replace(text, rf"^\s*(?:{LABEL_BULLET}\s*)*(?:\d{{1,2}}\s*[.)]|\d{{1,2}}(?=\s)|[가-힣]\s*[.)]|[①-⑳㉮-㉻])?\s*", "")
    text = F.regexp_replace(text, BLANK, "")
    text = F.regexp_replace(text, r"(?<=[가-힣])[.,．，、](?=[가-힣])", "·")
    return F.lower(F.regexp_replace(text, r"[:：]+$", ""))


def outer_part(label: Column | str) -> Column:
    """What stands before the first bracket, null without a pair of brackets."""
    return group(label, r"(?s)^([^(]+)\(.*\)", 1)


def inner_part(label: Column | str) -> Column:
    """What stands between the first bracket and the last."""
    return F.when(_col(label).rlike(r"(?s)^[^(]+\(.*\)"), F.regexp_extract(_col(label), r"(?s)^[^(]+\((.*)\)", 1))


def is_label_line(c: Column | str) -> Column:
    # a look for the colon first: most lines have none
    colon = F.contains(_col(c), F.lit(":")) | F.contains(_col(c), F.lit("："))
    return F.coalesce(F.when(colon, _col(c).rlike(LABEL_LINE)), F.lit(False))


def behind_colon(c: Column | str) -> Column:
    """The value of a label line, the second group of its pattern but for blanks before it: the pattern's colon is the first.

    Only a line terminator that Java ends a text before needs the pattern itself.
    """
    text = _col(c)
    odd = F.contains(text, F.lit("\u0085")) | F.contains(text, F.lit("\u2028")) | F.contains(text, F.lit("\u2029"))
    return F.when(odd, F.regexp_extract(text, LABEL_LINE, 2)).otherwise(F.substr(text, F.instr(F.translate(text, "：", ":"), ":") + 1))


def line_number(c: Column | str) -> Column:
    """The number that enumerates a line, 0 without one."""
    return F.coalesce(F.regexp_extract(_col(c), LINE_NUMBER, 1).try_cast("int"), F.lit(0))


def keeps_unknown_label(label: Column | str, value: Column | str) -> Column:
    """Whether a label that no item knows is worth keeping: short, without digits, brackets in pairs, a value with content."""
    label, value = _col(label), F.coalesce(_col(value), F.lit(""))
    pairs = F.regexp_count(label, F.lit(r"\(")) == F.regexp_count(label, F.lit(r"\)"))
    size = utf16_length(label)
    return F.coalesce((size > 0) & (size <= MAX_LABEL) & ~label.rlike(r"\p{Nd}") & pairs & value.rlike(r"[\p{L}\p{Nd}]"), F.lit(False))


def let(value: Column, use) -> Column:
    """use(value) with value made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def date_iso(c: Column | str) -> Column:
    """The first date as yyyy-mm-dd text. The first notation that is found decides, even if its numbers are out of range.

    Days go to 31 in any month: whether the calendar has the date is for the loader to say.
    """
    found = F.when(_col(c).rlike(DATE_MARK), F.coalesce(*[group(c, pattern, 0) for pattern in (DATE_KOREAN, DATE_NUMERIC, DATE_SHORT)]))

    def made(n: Column) -> Column:
        y, m, d = (F.get(n, F.lit(i)) for i in range(3))
        ok = m.try_cast("int").between(1, 12) & d.try_cast("int").between(1, 31)
        return F.when(ok, F.concat_ws("-", F.concat(F.when(F.length(y) == 2, "20").otherwise(""), y), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))

    return let(F.regexp_extract_all(found, F.lit(r"([0-9]+)"), 1), made)


def range_halves(c: Column | str) -> Column:
    """struct(lo, hi) of a period's two texts, null unless both have content."""
    parts = F.transform(F.split(trim_control(F.replace(_col(c), F.lit("까지"), F.lit(""))), RANGE_MARK, 2), lambda p: trim_control(p))
    lo, hi = (lambda p: F.get(p, F.lit(0))), (lambda p: F.get(p, F.lit(1)))
    return let(parts, lambda p: F.when((F.size(p) == 2) & ~is_blank(lo(p)) & ~is_blank(hi(p)), F.struct(lo(p).alias("lo"), hi(p).alias("hi"))))


def range_literal(start: Column | str, end: Column | str) -> Column:
    """[start,end], null unless both are there in order."""
    start, end = _col(start), _col(end)
    return F.when(end >= start, F.concat(F.lit("["), start, F.lit(","), end, F.lit("]")))


def literal_range(c: Column | str) -> Column:
    """struct(start_dt, end_dt) of a literal [a,b]; null where the form is another or the calendar lacks a date."""
    form = r"^\[(\d{4}-\d{2}-\d{2}),(\d{4}-\d{2}-\d{2})\]$"
    lo, hi = (F.regexp_extract(_col(c), form, i).try_cast("date") for i in (1, 2))
    return F.when(lo.isNotNull() & hi.isNotNull(), F.struct(lo.alias("start_dt"), hi.alias("end_dt")))


def overlaps(period: Column, low: Column, high: Column) -> Column:
    """Whether an inclusive period has a day in [low, high)."""
    return (period["start_dt"] < high) & (period["end_dt"] >= low)


def address(c: Column | str) -> Column:
    return F.nullif(trim_control(F.regexp_extract(_col(c), ADDRESS, 0)), F.lit(""))


def is_caption(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(CAPTION), F.lit(False))


def _compact_number(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\s+", ""), "^(고시|공고)제", "$1 제")


def notice_number(line: Column | str, before: Column | str | None = None) -> Column:
    """struct(agency, number) of a line that is a notice's number, or follows a header line and is a bare serial."""
    text = trim_control(_col(line))
    agency = lambda pattern: F.nullif(trim_control(F.regexp_extract(text, pattern, 1)), F.lit(""))
    full = F.struct(agency(NOTICE_LINE).alias("agency"), _compact_number(F.regexp_extract(text, NOTICE_LINE, 2)).alias("number"))
    out = F.when(text.rlike(NOTICE_LINE), full)
    serial = F.contains(_col(line), F.lit("호"))  # most lines have none
    if before is None:
        return F.when(serial, out)
    head = trim_control(_col(before))
    kind = F.regexp_replace(F.regexp_extract(head, NOTICE_HEADER, 1), r"\s+", "")
    bare = F.struct(agency(BARE_SERIAL).alias("agency"), _compact_number(F.concat(kind, F.regexp_extract(text, BARE_SERIAL, 2))).alias("number"))
    return F.when(serial, out.when(head.rlike(NOTICE_HEADER) & ~is_label_line(_col(line)) & text.rlike(BARE_SERIAL), bare))


def unspaced(c: Column | str) -> Column:
    """A text whose letters stand apart, drawn together; two blanks or more part words. Others come trimmed only."""
    text = trim_control(_col(c))
    apart = text.contains(" ") & ~text.rlike(r"\S\S")
    words = F.transform(F.split(text, r"\s{2,}"), lambda w: F.regexp_replace(w, r"\s+", ""))
    return F.when(apart, F.array_join(words, " ")).otherwise(text)


def signer_name(c: Column | str) -> Column:
    return trim_control(F.regexp_replace(trim_control(F.coalesce(_col(c), F.lit(""))), r"[^가-힣·\s]+\s*$", ""))


def is_signer(c: Column | str) -> Column:
    # a look for the titles' own letters first: the pattern of names is slow on long lines
    title = F.contains(_col(c), F.lit("장")) | F.contains(_col(c), F.lit("군수")) | F.contains(_col(c), F.lit("지사"))
    return F.coalesce(F.when(title, signer_name(c).rlike(SIGNER)), F.lit(False))


def normalise_title(c: Column | str) -> Column:
    """The form in which types are told from titles: no dots or blanks, one spelling of the usual words, no statute's name."""
    text = F.regexp_replace(_col(c), r"[·ㆍ․‧∙\s]+", "")
    for old, new in (("점용사용", "점사용"), ("점용", "점사용"), ("점사용사용", "점사용")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(F.lower(text), STATUTE, "")


def flat_value(c: Column | str) -> Column:
    return trim_control(F.regexp_replace(_col(c), BLANK, " "))


def approval_parts(c: Column | str) -> Column:
    """struct(number, date): a date in brackets at the end of an approval number apart from it, as it stands; else the number alone."""
    text = trim_control(_col(c))
    form = r"(?s)^(.*?)[(（]([^()（）]*)[)）]\s*$"
    number, date = trim_control(F.regexp_extract(text, form, 1)), trim_control(F.regexp_extract(text, form, 2))
    split = text.rlike(form) & date_iso(date).isNotNull() & (number != "")
    return F.struct(F.when(split, number).otherwise(text).alias("number"), F.when(split, date).alias("date"))


def solid_chars(c: Column | str) -> Column:
    """UTF-16 units that are not white space (no-break spaces count as content)."""
    return F.coalesce(utf16_length(F.regexp_replace(_col(c), f"[{SPACES}]", "")), F.lit(0))


def skip_reason(chars: Column | str, threshold: int = 5000) -> Column:
    """Why a body is too long to load, null where it is not; a threshold of 0 or less means there is none."""
    if threshold <= 0:
        return F.lit(None).cast("string")
    chars = _col(chars)
    return F.when(chars > threshold, F.concat(F.lit("본문 "), F.format_number(chars, 0), F.lit(f"자 (임계 {threshold:,}자 초과)")))


def yes_no(c: Column | str) -> Column:
    return F.when(_col(c), "Y").otherwise("N")


def is_yes(c: Column | str) -> Column:
    return F.coalesce(_col(c) == "Y", F.lit(False))


def html_escape(c: Column | str) -> Column:
    text = F.coalesce(_col(c), F.lit(""))
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", ""), ("\n", "<br>")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def markdown_cell(c: Column | str, width: int = 60) -> Column:
    """One line of at most width characters, safe between pipes; a dash for nothing."""
    flat = F.replace(trim_control(F.regexp_replace(_col(c), r"\s+", " ")), F.lit("|"), F.lit("\\|"))
    cut = F.when(F.length(flat) > width, F.concat(F.left(flat, F.lit(width - 1)), F.lit("…"))).otherwise(flat)
    return F.when(is_blank(c), "—").otherwise(cut)


def key_hash(c: Column | str) -> Column:
    return F.sha2(_col(c), 256)
