"""Personal data replaced by surrogates, with DataFrame functions only (operator 10).

Entities are found by one pattern. Each distinct one (its norm: case or separators do not matter where they carry no
meaning) gets one surrogate for the whole corpus, drawn with a key, so that mentions of the same entity stay mentions
of the same one. A name is detected behind a title or words that introduce one; what the same text calls by it
elsewhere goes too. A number of 13 to 19 digits in a row whose check digit is wrong is no card and stays; so do
addresses with parts above 255. The surrogate has the type, letter case, separators and script of what it replaces;
names keep gender and place (first or last), all others their length; cards keep a valid check digit, addresses go to
reserved ranges and domains. A check over all entities finds surrogates that two would share, or that are somebody's
real data; the later of them draw again, until all are distinct. Texts without entities never enter a shuffle of their own: only places and surrogates do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm._common import carried, cut, pick, remove, restored

#: A deployment sets its own; with the key nobody can tell from a surrogate which entity it stands for.
DEFAULT_KEY = "tidemark"

TITLES_F = "Mrs|Ms|Miss|Frau|Mme|Mlle|Sra|Srta|Señora|Doña|Г-жа|Κα"
TITLES_M = "Mr|Herr|Sr|Señor|Don|Г-н|Κος"
TITLES_N = "Dr|Prof"
#: What introduces a name without a title.
INTRODUCED = "[Mm]y name is|[Nn]ame:|Contact:|Author:|Ich heiße|Mein Name ist|Je m['’]appelle|Me llamo|Mi nombre es"
#: A look at one letter comes first here and below: nearly all places of a text fail there, at the least cost.
TITLE = f"(?<![\\p{{L}}])(?:{TITLES_F}|{TITLES_M}|{TITLES_N}|{INTRODUCED})\\.? "
#: A capital and small letters, or letters of a script without case.
NAME = "(?:\\p{Lu}[\\p{Ll}'’\\-]+(?:\\p{Lu}\\p{Ll}+)?|[\\p{IsHan}\\p{IsHangul}]{1,4})"
SHORT_NAME = "(?:\\p{Lu}[\\p{Ll}'’\\-]{1,20}(?:\\p{Lu}\\p{Ll}{1,20})?|[\\p{IsHan}\\p{IsHangul}]{1,4})"

EMAIL = "(?<![A-Za-z0-9._%+\\-])[A-Za-z0-9._%+\\-]++@[A-Za-z0-9\\-]+(?:\\.[A-Za-z0-9\\-]+)+"
OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
IP = f"(?<![0-9.])(?:{OCTET}\\.){{3}}{OCTET}(?![0-9]|\\.[0-9])"
SSN = "(?<![0-9\\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\\-])"
PHONE = "(?:\\+[0-9]{1,3}[ .\\-]?)?\\([0-9]{2,4}\\)[ .\\-]?[0-9]{3,4}[ .\\-]?[0-9]{3,4}(?![0-9])|\\+[0-9]{1,3}(?:[ .\\-]?[0-9]{2,4}){2,5}(?![0-9])|(?<![0-9.\\-])[0-9]{3}[.\\-][0-9]{3}[.\\-][0-9]{4}(?![0-9])"
CARD = "(?<![0-9A-Za-z])[0-9](?:[ \\-]?[0-9]){12,18}(?![0-9A-Za-z])"
IBAN = "(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
SECRET_NAME = "token|secret|api_key|apikey|access_key|password|passwd|pwd"
#: Only the value goes; what names it stays.
SECRET = f"(?<=[=:]|[=:][\\s\"']|[=:]\\s[\\s\"']|[=:]\\s\\s[\\s\"']|[=:]\\s\\s\\s[\"'])(?<=(?i:{SECRET_NAME})[\"']?\\s{{0,3}}[=:]\\s{{0,3}}[\"']?)[A-Za-z0-9_+/\\-]{{8,}}"
HEX = "(?<![0-9A-Za-z])(?=[0-9a-fA-F]{32})(?=[a-fA-F]*[0-9])(?=[0-9]*[a-fA-F])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])"
INITIAL = "\\p{Lu}(?=\\.)"
#: What of a name may stand between its title and a further part.
PART = f"(?:{SHORT_NAME} |\\p{{Lu}}\\. ?)"
PARTS = f"(?:|{PART}|{PART}{PART}|{PART}{PART}{PART})"
PERSON = f"(?=[\\p{{Lu}}\\p{{IsHan}}\\p{{IsHangul}}])(?<=[ .])(?<={TITLE}{PARTS})(?:{NAME}|{INITIAL})"
ENTITY = "|".join((SECRET, HEX, IP, SSN, CARD, PHONE, EMAIL, IBAN, PERSON))
#: Texts with an entity have one of these, told faster than the entities themselves.
HINT = "[0-9@]"
HINT_NAMES = f"(?=[DFHMPSГКmnACIJN]){TITLE}"
HINT_SECRET = f"(?i)(?:{SECRET_NAME})[\"']?\\s*[=:]"

#: First names by gender, and what last names are built of, by script.
FIRST = {
    "latin": ("Anna Clara Elena Julia Laura Maria Nina Paula Rosa Sofia Vera Emma", "Adam Bruno Carl David Erik Felix Hugo Jonas Leo Martin Oscar Paul", "Alex Kim Robin Sascha Andrea Dominique Charlie Noel Jean Toni Gabriele Sam"),
    "cyrillic": ("Анна Вера Дарья Елена Ирина Лидия Мария Нина Ольга Полина Софья Юлия", "Антон Борис Виктор Глеб Денис Иван Кирилл Лев Максим Олег Павел Юрий", "Саша Женя Валя Слава Шура Паша Тоня Кира Леся Вася Миша Юра"),
    "greek": ("Άννα Βάσω Δάφνη Ελένη Ζωή Ηρώ Ιωάννα Κλειώ Λίνα Μαρία Νίκη Σοφία", "Άρης Βασίλης Γιάννης Δήμος Ηλίας Κώστας Λουκάς Μάρκος Νίκος Πέτρος Σπύρος Φώτης", "Άλεξ Άντζη Βίκυ Λία Μάνια Ρένα Σίσσυ Τόνια Φαίη Χαρά Ήβη Εύα"),
    "hangul": ("지은 수진 민지 은영 혜진 유진 서연 하은 지현 미영 수빈 예은", "민수 영호 성민 준호 동현 상우 진우 태영 현준 재석 지훈 승현", "지수 하나 은수 현진 수현 지원 민경 유현 정은 서진 하늘 가람"),
    "han": ("芳 娜 敏 静 丽 燕 艳 娟 霞 秀英 玉兰 桂英", "伟 强 磊 军 勇 涛 明 杰 刚 建国 志强 文斌", "华 平 文 宁 晨 安 林 新 阳 雨 乐 清"),
}
LAST = {
    "latin": ("Ber Cal Dor Fen Gar Hal Lin Mor Nor Rav Sel Tor", "ba di ga le mi no ra so ta ve zi lo", "nen sson rick mann tier dez well lin court mer ley gard"),
    "cyrillic": ("Бел Вор Гор Дав Зим Кор Лав Мор Нов Рад Сав Тур", "а е и о у я ан ев ин ов ар ен", "цкий нко дзе швили вич лик мак рук чук дюк няк зик"),
    "greek": ("Βαρ Γαλ Δημ Καρ Λαμ Μαν Νικ Παπ Ραλ Σαρ Ταμ Φωτ", "α ε ι ο ου αν ιν ον αρ ερ ορ ατ", "ίδης άκης όπουλος έλης άτος ίνος ιάδης ούλης ούσης ώνης ίτης άνης"),
    "hangul": ("남 도 류 마 방 서 안 오 임 장 하 황", "궁 고 독 동 제 선 사 황 보 우 목 포", "가 나 다 라 마 바 사 아 자 차 타 하"),
    "han": ("赵 钱 孙 李 周 吴 郑 王 冯 陈 褚 卫", "东 南 西 北 上 下 左 右 前 后 内 外", "子 山 川 江 河 湖 海 田 石 木 林 谷"),
}


def _array(words: str) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words.split()) + ")"


def _q(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _by_script(table: dict, at: int) -> str:
    return "CASE script " + " ".join(f"WHEN '{s}' THEN {_array(v[at])}" for s, v in table.items() if s != "latin") + f" ELSE {_array(table['latin'][at])} END"


def _draw(words: str, salt: str) -> str:
    """One of an array's words, drawn with the key."""
    return f"element_at({words}, 1 + cast(pmod(cast(conv(substr(sha2(concat_ws('|', key, 'word', {salt}, kind, norm, attempt), 256), 1, 12), 16, 10) as bigint), size({words})) as int))"


#: 256 hex digits drawn for an entity; for digits a to f fold.
_HEX = "concat(" + ", ".join(f"sha2(concat_ws('|', key, {i}, kind, norm, attempt), 256)" for i in range(4)) + ")"
_LUHN = (
    "pmod(aggregate(sequence(1, length({d})), 0, (a, i) -> a + CASE WHEN (length({d}) - i) % 2 = 0 THEN cast(substr({d}, i, 1) as int)"
    " ELSE cast(substr('0246813579', 1 + cast(substr({d}, i, 1) as int), 1) as int) END), 10)"
)


def _alike(s: str, stream: str) -> str:
    """s with each letter and digit replaced by one of its kind from the stream; long ones use the stream again and again."""
    at = f"substr({stream}, 1 + (i % 256), 1)"
    return (
        f"array_join(transform(split({s}, ''), (c, i) -> CASE WHEN c rlike '^[0-9]$' THEN translate({at}, 'abcdef', '012345')"
        f" WHEN c rlike '^[a-z]$' THEN translate({at}, '0123456789', 'ghijklmnop') WHEN c rlike '^[A-Z]$' THEN upper(translate({at}, '0123456789', 'GHIJKLMNOP')) ELSE c END), '')"
    )


def _initial() -> str:
    """A capital of the same script, not the one that it replaces; there are too few for each to have its own."""
    letters = "(CASE script WHEN 'cyrillic' THEN 'АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ' WHEN 'greek' THEN 'ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ' ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' END)"
    step = f"cast(pmod(cast(conv(substr(stream, 1, 12), 16, 10) as bigint), length({letters}) - 1) as int)"
    return f"substr({letters}, 1 + pmod(instr({letters}, upper(norm)) + {step}, length({letters})), 1)"


def surrogates(entities: DataFrame) -> DataFrame:
    """kind, norm, hex, valid, script, gender, key, attempt -> the same with drawn: the surrogate of this attempt."""
    octet = "cast(conv(substr(stream, {0}, 2), 16, 10) as int)"
    # reserved addresses first; if there are ever more entities than these, any
    ip = "concat_ws('.', CASE WHEN attempt < 8 THEN 240 + pmod(" + octet.format(1) + ", 15) ELSE " + octet.format(1) + " END, " + ", ".join(octet.format(i) for i in (3, 5, 7)) + ")"
    digits = f"concat(substr(norm, 1, greatest(0, CASE kind WHEN 'phone' THEN length(norm) - 10 WHEN 'card' THEN 1 ELSE 0 END)), substr({_alike('norm', 'stream')}, 1 + greatest(0, CASE kind WHEN 'phone' THEN length(norm) - 10 WHEN 'card' THEN 1 ELSE 0 END)))"
    hex_ = "array_join(transform(split(norm, ''), (c, i) -> CASE WHEN upper(norm) = norm THEN upper(substr(stream, 1 + (i % 256), 1)) ELSE substr(stream, 1 + (i % 256), 1) END), '')"
    # more attempts give longer compounds, so names never run out
    first = "array_join(transform(sequence(0, cast(attempt / 2 as int)), j -> " + _draw(f"(CASE gender WHEN 'f' THEN {_by_script(FIRST, 0)} WHEN 'm' THEN {_by_script(FIRST, 1)} ELSE {_by_script(FIRST, 2)} END)", "j") + "), '-')"
    last = "concat(" + _draw(f"({_by_script(LAST, 0)})", "'a'") + ", array_join(transform(sequence(0, attempt), j -> " + _draw(f"({_by_script(LAST, 1)})", "j") + "), ''), " + _draw(f"({_by_script(LAST, 2)})", "'z'") + ")"
    host = _alike("regexp_replace(split_part(norm, '@', 2), '\\\\\\\\.[^.]*$', '')", "hosts")
    with_streams = (
        entities.withColumn("stream", F.expr(_HEX))
        # all addresses at a host go to one host
        .withColumn("hosts", F.expr("repeat(sha2(concat_ws('|', key, 'host', split_part(norm, '@', 2)), 256), 4)"))
        .withColumn("digits", F.when(F.col("kind").isin("card", "phone", "ssn"), F.expr(digits)))
    )
    checked = f"CASE WHEN kind = 'card' AND valid THEN concat(left(digits, length(digits) - 1), pmod(10 - {_LUHN.format(d='concat(left(digits, length(digits) - 1), chr(48))')}, 10)) ELSE digits END"
    drawn = F.expr(
        f"CASE kind WHEN 'email' THEN concat({_alike('split_part(norm, chr(64), 1)', 'stream')}, '@', {host}, '.example') WHEN 'ip' THEN {ip} WHEN 'hex' THEN {hex_} WHEN 'first' THEN {first} WHEN 'last' THEN {last} WHEN 'initial' THEN {_initial()}"
        f" WHEN 'card' THEN {checked} WHEN 'phone' THEN digits WHEN 'ssn' THEN digits ELSE {_alike('norm', 'stream')} END"
    )
    return with_streams.withColumn("drawn", drawn).drop("stream", "hosts", "digits")


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, norm, drawn: of distinct entities (kind, norm, valid, script, gender), with all of drawn distinct and nobody's, but for initials."""
    now = cut(surrogates(entities.withColumn("key", F.lit(key)).withColumn("attempt", F.lit(0))), "surrogates")
    while True:
        same = Window.partitionBy("kind", "drawn").orderBy("attempt", "norm")
        # names in one form: a norm has small letters and, of first names, the gender
        real = now.select("kind", F.expr("CASE WHEN kind = 'first' THEN substring_index(norm, '/', 1) ELSE norm END").alias("form")).distinct().withColumn("taken", F.lit(True))
        form = F.expr("CASE WHEN kind IN ('first', 'last') THEN lower(drawn) ELSE drawn END")
        judged = now.withColumn("nth", F.row_number().over(same)).withColumn("form", form).join(real, ["kind", "form"], "left")
        clash = ((F.col("nth") > 1) | F.col("taken").isNotNull()) & (F.col("kind") != "initial")
        if not now_clashes(judged, clash):
            return now.select("kind", "norm", "drawn")
        again = surrogates(judged.where(clash).select("kind", "norm", "valid", "script", "gender", "key", (F.col("attempt") + 1).alias("attempt")))
        after = cut(judged.where(~clash).select(*now.columns).unionByName(again.select(*now.columns)), "surrogates")
        remove(now.sparkSession, now)
        now = after


def now_clashes(judged: DataFrame, clash) -> bool:
    return not judged.where(clash).select("kind").isEmpty()


def _pattern(own):
    """ENTITY, or with it the names that a text has as its own."""
    return F.when(own.isNull(), F.lit(ENTITY)).otherwise(F.concat(F.lit(ENTITY), own))


def _bare(name):
    return F.regexp_replace(name, "['’]s$", "")


def _own_names():
    """An alternative for the names behind titles in the text, as whole words, the longest first; null where there are none."""
    titled = F.filter(F.regexp_extract_all("text", F.lit(f"({PERSON})"), 1), lambda n: ~n.rlike("^\\p{Lu}$"))
    forms = F.array_distinct(F.flatten(F.transform(titled, lambda n: F.array(_bare(n), F.upper(_bare(n))))))
    longest = F.transform(F.array_sort(F.transform(forms, lambda n: F.struct((-F.length(n)).alias("less"), n.alias("n")))), lambda x: x["n"])
    listed = F.concat(F.lit("|(?<![\\p{L}\\p{N}_])(?:"), F.array_join(longest, "|"), F.lit(")(?![\\p{L}\\p{N}_])"))
    return F.when(F.col("text").rlike(HINT_NAMES) & (F.size(titled) > 0), listed)


def mentions(rows: DataFrame) -> DataFrame:
    """doc, th, own, pos, hit, kind, norm, valid, script, gender: a row for each place of a text that the pattern takes.

    Kind is name where a name of the text stands without a title, and none for numbers that only look like cards.
    """
    text = F.col("text")
    hinted = text.rlike(HINT) | ((F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(HINT_SECRET)) | text.rlike(HINT_NAMES)
    named = rows.where(hinted).select("doc", "th", "text", _own_names().alias("own"))
    pattern = _pattern(F.col("own"))
    found = named.select("doc", "th", "own", F.regexp_extract_all("text", F.concat(F.lit("("), pattern, F.lit(")")), 1).alias("hits"), F.split("text", pattern, -1).alias("rest"))
    # what stands before, with up to three entities in it
    chain = ", ".join(f"coalesce(right(get(rest, i - {k}), 24), ''), coalesce(get(hits, i - {k}), '')" for k in (3, 2, 1))
    around = f"transform(hits, (h, i) -> struct(h as hit, right(rest[i], 24) as before, concat({chain}, right(rest[i], 24)) as chain, left(rest[i + 1], 2) as after, coalesce(get(hits, i + 1), '') as following))"
    each = found.select("doc", "th", "own", F.posexplode(F.expr(around)).alias("pos", "e"))
    each = each.select("doc", "th", "own", "pos", "e.*")
    digits = F.expr("regexp_replace(hit, '[^0-9]', '')")
    kind = F.expr(
        rf"""CASE WHEN hit LIKE '%@%' THEN 'email'
        WHEN hit rlike r'^([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}$' THEN 'ip'
        WHEN before rlike r'(?i)(?:token|secret|api_key|apikey|access_key|password|passwd|pwd)["\x27]?\s*[=:]\s*["\x27]?$' OR hit rlike '^([0-9a-f]{{32,}}|[0-9A-F]{{32,}})$' THEN CASE WHEN hit rlike '^([0-9a-f]+|[0-9A-F]+)$' THEN 'hex' ELSE 'secret' END
        WHEN hit rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN 'ssn'
        WHEN hit rlike r'^[+(]|^[0-9]{{3}}[.\-][0-9]{{3}}[.\-][0-9]{{4}}$' THEN 'phone'
        WHEN hit rlike r'^[0-9 \-]+$' THEN 'card'
        WHEN hit rlike '^[A-Z]{{2}}[0-9]{{2}}' THEN 'iban'
        WHEN NOT chain rlike {_q(f'{TITLE}{PARTS}$')} THEN 'name'
        WHEN hit rlike r'^\p{{Lu}}$' THEN 'initial'
        WHEN after = ' ' AND following rlike {_q(f'^(?:{NAME}|[\\p{{Lu}}])$')} THEN 'first' ELSE 'last' END"""
    )
    script = F.expr(r"CASE WHEN hit rlike r'\p{IsCyrillic}' THEN 'cyrillic' WHEN hit rlike r'\p{IsGreek}' THEN 'greek' WHEN hit rlike r'\p{IsHangul}' THEN 'hangul' WHEN hit rlike r'\p{IsHan}' THEN 'han' ELSE 'latin' END")
    gender = F.expr(f"CASE WHEN kind <> 'first' THEN '' WHEN chain rlike {_q(f'(?<![\\p{{L}}])(?:{TITLES_F})[.]? {PARTS}$')} THEN 'f' WHEN chain rlike {_q(f'(?<![\\p{{L}}])(?:{TITLES_M})[.]? {PARTS}$')} THEN 'm' ELSE 'n' END")
    norm = F.when(F.col("kind").isin("ssn", "phone", "card"), digits).when(F.col("kind") == "iban", F.expr("replace(hit, ' ', '')")).when(F.col("kind").isin("first", "last", "initial", "name"), F.lower(_bare(F.col("hit")))).when(F.col("kind") == "email", F.lower("hit")).otherwise(F.col("hit"))
    each = each.withColumn("kind", kind).withColumn("norm", norm).withColumn("script", script).withColumn("gender", gender)
    valid = F.expr(f"CASE WHEN kind = 'card' THEN {_LUHN.format(d='norm')} = 0 ELSE false END")
    plain = F.expr("CASE WHEN kind = 'card' AND NOT valid AND hit = norm THEN 'none' ELSE kind END")
    # a first name of another gender is another entity
    return each.withColumn("valid", valid).withColumn("kind", plain).withColumn("norm", F.expr("CASE WHEN kind = 'first' THEN concat(norm, '/', gender) ELSE norm END")).drop("before", "chain", "after", "following")


def resolved(found: DataFrame) -> DataFrame:
    """found with the kind, norm and gender of names without a title: those of the first titled mention in the same text."""
    same = Window.partitionBy("doc", "th", F.lower(_bare(F.col("hit"))))
    titled = F.min(F.when(F.col("kind").isin("first", "last"), F.struct("pos", "kind", "norm", "gender"))).over(same)
    open_ = F.col("kind") == "name"
    now = found.withColumn("titled", titled)
    new = {"kind": F.when(open_, F.coalesce("titled.kind", F.lit("last"))).otherwise(F.col("kind")), "norm": F.when(open_, F.coalesce("titled.norm", "norm")).otherwise(F.col("norm")), "gender": F.when(open_, F.coalesce("titled.gender", F.lit(""))).otherwise(F.col("gender"))}
    return now.select(*[new[c].alias(c) if c in new else c for c in found.columns])


#: The surrogate in the form of what it replaces: separators as they stand, capitals where all letters are.
_RENDER = r"""CASE WHEN kind IN ('ssn', 'phone', 'card', 'iban') THEN array_join(transform(sequence(1, length(hit)), i -> CASE WHEN substr(hit, i, 1) rlike '[0-9A-Za-z]' THEN substr(drawn, length(regexp_replace(substr(hit, 1, i), '[^0-9A-Za-z]', '')), 1) ELSE substr(hit, i, 1) END), '')
    WHEN kind IN ('first', 'last') THEN concat(CASE WHEN upper(hit) = hit AND lower(hit) <> hit THEN upper(drawn) ELSE drawn END, regexp_extract(hit, r'[\x27’]s$', 0))
    WHEN kind = 'email' AND upper(hit) = hit THEN upper(drawn) ELSE drawn END"""


def replacements(rows: DataFrame, key: str) -> DataFrame:
    """doc, th, own, put, kinds: the surrogates of a text in order, and their kinds; own is its names' part of the pattern."""
    found = cut(resolved(mentions(rows).dropDuplicates(["doc", "th", "pos"])), "mentions")
    entities = found.where("kind <> 'none'").groupBy("kind", "norm").agg(F.max("valid").alias("valid"), F.min("script").alias("script"), F.min("gender").alias("gender"))
    named = distinct_surrogates(entities, key)
    # named is cut: Spark splits the mentions of an entity that very many texts have over tasks
    put = found.join(named, ["kind", "norm"], "left").withColumn("put", F.when(F.col("drawn").isNull(), F.col("hit")).otherwise(F.expr(_RENDER)))
    listed = put.groupBy("doc", "th").agg(F.max("own").alias("own"), F.array_sort(F.collect_list(F.struct("pos", "put", "kind"))).alias("all"))
    return listed.select("doc", "th", "own", F.col("all.put").alias("put"), F.array_remove("all.kind", "none").alias("kinds")).where(F.size("kinds") > 0)


def _replaced():
    pieces = F.split("text", _pattern(F.col("own")), -1)
    woven = F.concat_ws("", F.flatten(F.zip_with(pieces, F.col("put"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))))
    return F.when(F.col("put").isNull(), F.col("text")).otherwise(woven)


def _names():
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")]


def surrogate_pii(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """One row for each row of docs: doc_id, text (replaced), n_entities, kinds.

    Null and empty texts stay as they are, with no entities. Rows that repeat give the same. A null doc_id is like any
    other. Other columns are ignored; no rows give none. Names are found behind a title or an introduction, and
    elsewhere in the same text as whole words.
    """
    rows = pick(docs, doc_id="bigint", text="string").select("doc_id", "text", *_names())
    joined = rows.join(replacements(rows, key), ["doc", "th"], "left")
    return joined.select("doc_id", _replaced().alias("text"), F.coalesce(F.size("kinds"), F.lit(0)).cast("long").alias("n_entities"), F.coalesce("kinds", F.array().cast("array<string>")).alias("kinds"))


def replace_pii(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """docs with personal data in text replaced and n_chars set anew there; all rows and columns stay."""
    rows = carried(docs, doc_id="bigint", text="string", n_chars="bigint").select("row", "text", "n_chars", *_names())
    joined = rows.join(replacements(rows, key), ["doc", "th"], "left").withColumn("new_text", _replaced())
    return restored(joined, docs.columns, text=F.col("new_text"), n_chars=F.when(F.col("put").isNull(), F.col("n_chars")).otherwise(F.length("new_text").cast("long")))
