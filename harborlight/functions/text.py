"""Scalar normalisers as Column expressions. All keep nulls null and never fail on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean yes and no.
YES = ("Y", "YES", "1", "TRUE", "가능", "있음", "유", "O")
NO = ("N", "NO", "0", "FALSE", "불가능", "없음", "무", "X")
# Category words in order of precedence, and the code of each group.
CATEGORIES = (
    (("한식", "분식", "김밥", "백반", "국밥"), "food_korean"),
    (("중식", "중국"), "food_chinese"),
    (("일식", "초밥"), "food_japanese"),
    (("양식", "경양식"), "food_western"),
    (("카페", "커피"), "food_cafe"),
    (("미용",), "beauty"),
    (("목욕", "세탁"), "bath"),
    (("숙박",), "lodging"),
)
NON_FOOD = ("미용", "목욕", "세탁", "숙박", "이미용")
FOOD = ("요식", "음식", "한식", "중식", "일식", "양식", "분식", "식당", "카페")
# Words that block a place, and words that block it when a menu holds them.
BLOCK_PLACE = ("커트", "파마", "세탁", "미용", "헤어", "이발", "이미용", "숙박", "모텔", "호텔", "펜션")
BLOCK_MENU = ("커트", "파마", "세탁")
# Region names and their short forms, replaced in this order.
REGIONS = (
    ("서울특별시", "서울"),
    ("부산광역시", "부산"),
    ("대구광역시", "대구"),
    ("인천광역시", "인천"),
    ("광주광역시", "광주"),
    ("대전광역시", "대전"),
    ("울산광역시", "울산"),
    ("세종특별자치시", "세종"),
    ("경기도", "경기"),
    ("강원특별자치도", "강원"),
    ("강원도", "강원"),
    ("충청북도", "충북"),
    ("충청남도", "충남"),
    ("전북특별자치도", "전북"),
    ("전라북도", "전북"),
    ("전라남도", "전남"),
    ("경상북도", "경북"),
    ("경상남도", "경남"),
    ("제주특별자치도", "제주"),
    ("제주도", "제주"),
)
CITY, CITY_FULL = "부산", "부산광역시"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """Text without outer white space, null if nothing is left (PRJ-1)."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


#: What Python's float() reads, in ASCII: digits with single underscores between them, or a name.
_DIGITS = r"[0-9](_?[0-9])*"
NUMBER = rf"(?i)^[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)$"


def to_double(c: Column, commas: bool = False) -> Column:
    """Number or null, in the forms of Python's float(); with `commas`, thousands separators are dropped first (PRJ-2, PRJ-3)."""
    text = blank_to_null(c)
    text = F.replace(text, F.lit(","), F.lit("")) if commas else text
    return F.when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def yes_no(c: Column) -> Column:
    """True, false or null for words of yes and no (PRJ-4)."""
    word = F.upper(blank_to_null(c))
    return F.when(word.isin(*YES), True).when(word.isin(*NO), False)


def parse_price(c: Column) -> Column:
    """First number of a price text; null if its commas are not thousands separators (PRJ-5)."""
    token = F.regexp_extract(F.replace(blank_to_null(c), F.lit(" "), F.lit("")), r"[0-9][0-9,]*", 0)
    good = ~token.contains(",") | token.rlike(r"^[0-9]{1,3}(,[0-9]{3})+$")
    return F.when(good, F.replace(token, F.lit(","), F.lit("")).try_cast("int"))


def squeeze(c: Column) -> Column:
    """Text without any white space (PRJ-6, PRJ-29)."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def no_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(c.rlike("|".join(words)), F.lit(False))


def is_food(category: Column) -> Column:
    """Whether a category is food; a null one is, and words against beat words for (PRJ-9)."""
    text = no_spaces(category)
    return F.when(category.isNull(), True).when(contains_any(text, NON_FOOD), False).otherwise(contains_any(text, FOOD))


def category_code(category: Column) -> Column:
    """Code of a category by the first group with a word in it (PRJ-8)."""
    text = no_spaces(category)
    code = F.when(category.isNull(), F.lit(None).cast("string"))
    for group, name in CATEGORIES:
        code = code.when(contains_any(text, group), name)
    return code.when(is_food(category), "food_other").otherwise("other")


def kst_timestamp(c: Column) -> Column:
    """14 digits of Korean local time as an instant; null for anything else (PRJ-10)."""
    text = blank_to_null(c)
    return F.when(text.rlike("^[0-9]{14}$"), F.to_utc_timestamp(F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")), "Asia/Seoul"))


def impossible_time(c: Column) -> Column:
    """Whether a text has the 14 digits of a time that does not exist, which makes its record a reject (PRJ-10)."""
    text = blank_to_null(c)
    return F.coalesce(text.rlike("^[0-9]{14}$") & kst_timestamp(c).isNull(), F.lit(False))


def ymd(c: Column) -> Column:
    """YYYYMMDD as a date (PRJ-11)."""
    return F.when(c.rlike("^[0-9]{8}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd")).cast("date"))


def local_to_utc(c: Column, zone: str = "Asia/Seoul") -> Column:
    """Wall time of a zone as an instant (PRJ-12)."""
    return F.to_utc_timestamp(c, zone)


def text_hash(c: Column) -> Column:
    """SHA-256 of the stripped text, null if blank (PRJ-13)."""
    return F.sha2(blank_to_null(c), 256)


def fallback_id(row: Column, name: Column, address: Column, tel: Column) -> Column:
    """Stable id of a source row without one: hash of name, address, telephone and its sorted items (PRJ-14)."""
    items = F.array_sort(F.map_entries(row))
    none = F.lit("")
    return F.substring(F.sha2(F.concat_ws("|", F.coalesce(name, none), F.coalesce(address, none), F.coalesce(tel, none), F.to_json(items)), 256), 1, 32)


#: Folding of each character that has one, by Python's Unicode tables.
_FOLDED = {chr(i): chr(i).casefold() for i in range(0x10000) if not 0xD800 <= i < 0xE000 and chr(i).casefold() != chr(i)}
_FOLDED_ONE, _FOLDED_MORE = ({k: v for k, v in _FOLDED.items() if (len(v) == 1) == one} for one in (True, False))


def casefold(c: Column) -> Column:
    """Text without case, as str.casefold: also ß as ss, and one form of sigma."""
    wider = F.create_map(*[F.lit(x) for pair in _FOLDED_MORE.items() for x in pair])
    widened = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.element_at(wider, ch), ch)), "")
    text = F.when(c.rlike("[" + "".join(_FOLDED_MORE) + "]"), widened).otherwise(c)
    return F.translate(text, "".join(_FOLDED_ONE), "".join(_FOLDED_ONE.values()))


def menu_store_id(name: Column) -> Column:
    """Id shared by the rows of one store in the menu source (PRJ-15)."""
    return F.concat(F.lit("bsshNm:"), casefold(name))


def digits_as_int(c: Column) -> Column:
    """All digits of a text as one number (PRJ-16)."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")).try_cast("int")


def duration_minutes(c: Column) -> Column:
    """Hours and minutes of a duration text as minutes; null where it names neither."""
    hours = F.nullif(F.regexp_extract(c, "([0-9]+) *시간", 1), F.lit("")).try_cast("int")
    minutes = F.nullif(F.regexp_extract(c, "([0-9]+) *분", 1), F.lit("")).try_cast("int")
    none = F.lit(0)
    return F.when(hours.isNotNull() | minutes.isNotNull(), F.coalesce(hours, none) * 60 + F.coalesce(minutes, none))


def km(c: Column) -> Column:
    """Digits and dots of a distance text as kilometres (PRJ-17)."""
    return F.nullif(F.regexp_replace(c, "[^0-9.]", ""), F.lit("")).try_cast("decimal(7,3)")


def congestion_level(rate: Column) -> Column:
    """Level 1 to 5 of a rate, new levels at 20, 40, 60 and 80 (PRJ-18)."""
    level = F.when(rate.isNull(), F.lit(None).cast("int"))
    for i, bound in enumerate((20, 40, 60, 80), 1):
        level = level.when(rate < bound, i)
    return level.otherwise(5)


def short_district(code: Column, area: Column) -> Column:
    """District code without its area prefix (PRJ-19)."""
    return F.when(F.startswith(code, area), F.substring(code, F.length(area) + 1, F.length(code))).otherwise(code)


def long_district(code: Column, area: Column) -> Column:
    """District code with its area prefix (PRJ-20)."""
    return F.concat(area, code)


def match_name(c: Column) -> Column:
    """Name for comparison: no bracketed parts, only word characters; null as '' (PRJ-30)."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\([^)]*\)", ""), r"\[[^\]]*\]", "")
    return F.regexp_replace(text, r"(?U)[^\w가-힣]", "")


def match_address(c: Column) -> Column:
    """Address for comparison: short region names, no white space; null as '' (PRJ-31)."""
    text = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    for long, short in REGIONS:
        text = F.replace(text, F.lit(long), F.lit(short))
    return squeeze(text)


def match_phone(c: Column) -> Column:
    """Digits of a telephone number; null as '' (PRJ-32)."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def attraction_name(c: Column) -> Column:
    """Attraction name without parenthesised parts and white space (PRJ-33)."""
    return squeeze(F.regexp_replace(c, r"\([^)]*\)", ""))


def geocode_query(c: Column, region: str = CITY_FULL) -> Column:
    """Address as the geocoder wants it: no postcode or floor suffix, one of glued addresses, with the region (PRJ-36)."""
    text = F.nullif(strip(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))
    text = F.regexp_replace(text, r"^\([0-9]{5}\)\s*", "")
    parts = F.filter(F.transform(F.split(text, f"(?={CITY})"), strip), lambda p: p != "")
    road = F.filter(parts, lambda p: p.rlike(r"(로|길)\s*[0-9-]"))
    text = F.when(F.size(parts) <= 1, text).otherwise(F.coalesce(F.get(road, F.lit(0)), F.get(parts, F.lit(0))))
    text = F.regexp_replace(text, r",\s*[0-9]+~[0-9]+층\([^)]+\)\s*$", "")
    compact = no_spaces(text)
    widened = F.when(text.startswith(f"{CITY} ") & ~compact.contains("광역시"), F.regexp_replace(text, f"^{CITY} ", f"{region} ")).otherwise(text)
    return F.when(~compact.contains(CITY), F.concat(F.lit(f"{region} "), text)).otherwise(widened)


def mentions_city(c: Column) -> Column:
    """Whether an address names the city; null does not (PRJ-38)."""
    return F.coalesce(no_spaces(c).contains(CITY), F.lit(False))


def keyword_queries(name: Column, region: Column) -> Column:
    """Search texts of a place in order: with its district, then without (PRJ-39)."""
    with_region = F.when(F.coalesce(region, F.lit("")) != "", F.concat_ws(" ", F.lit(CITY), region, name))
    return F.array_distinct(F.filter(F.transform(F.array(with_region, F.concat_ws(" ", F.lit(CITY), name)), strip), lambda q: q.isNotNull() & (q != "")))


def display_address(addr1: Column, addr2: Column) -> Column:
    """Both address lines, null if both are blank (PRJ-43)."""
    return blank_to_null(F.concat_ws(" ", F.coalesce(addr1, F.lit("")), F.nullif(F.coalesce(addr2, F.lit("")), F.lit(""))))


def reject_label(row: Column, names: tuple[str, ...] = ("idx", "IDX", "UC_SEQ", "bsshNm", "업소명", "상호명", "상호", "MAIN_TITLE", "name")) -> Column:
    """Short label of a source row for reports: its first non-empty id or name, else the row (PRJ-45)."""
    return F.substring(F.coalesce(*[F.nullif(F.element_at(row, n), F.lit("")) for n in names], F.to_json(row)), 1, 120)


def blocked_place(name: Column, category: Column, representative: Column, menus: Column) -> Column:
    """Whether words in name, category or menus (array of structs with menu_name) block a place (FLT-1)."""
    own = contains_any(no_spaces(name), BLOCK_PLACE) | contains_any(no_spaces(category), BLOCK_PLACE) | contains_any(no_spaces(representative), BLOCK_PLACE)
    return own | F.coalesce(F.exists(menus, lambda m: contains_any(no_spaces(m["menu_name"]), BLOCK_MENU)), F.lit(False))


def half_up_mean(c: Column) -> Column:
    """Mean as a whole number, halves up (PRJ-47)."""
    return F.round(F.avg(c)).cast("int")


def run_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two instants (PRJ-48)."""
    return F.round(F.unix_micros(end) / 1e6 - F.unix_micros(start) / 1e6).cast("int")
