"""Text tokens, links and lineup cards of HTML pages.

Everything is computed inside the page's own row with array functions, so
no token is shuffled.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import literal_map
from slatework.functions.teams import PAGE, PAGE_TEAMS, team_code
from slatework.functions.text import page_title_date

# Markers on a lineup page.
TIME_MARK = r"(?i)^\d{1,2}:\d{2}\s*(AM|PM)\s*ET$"
STATUS_MARK = r"(?i)^(Confirmed|Expected)\s+Lineup$"
POSITION_MARK = r"(?i)^(C|1B|2B|3B|SS|LF|CF|RF|DH)$"
HAND_MARK = r"(?i)^[RLS]$"
ERA_MARK = r"(?i)ERA"
PAGE_DATE = r"(?i)Starting MLB lineups for ([A-Za-z]+ \d{1,2}, \d{4})"
END_MARKS = ["Home Run Odds", "Starting Pitcher Intel"]
PLAYER_LINK = r"/baseball/player/[^/]+-(\d+)"

_BREAK = "\u0001"
_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"
_TAG = r"(?s)<[^>]*>"


# What the numeric references 128 to 159 stand for in HTML.
_WINDOWS = {
    128: "€", 130: "‚", 131: "ƒ", 132: "„", 133: "…", 134: "†", 135: "‡", 136: "ˆ", 137: "‰",
    138: "Š", 139: "‹", 140: "Œ", 142: "Ž", 145: "‘", 146: "’", 147: "“", 148: "”", 149: "•",
    150: "–", 151: "—", 152: "˜", 153: "™", 154: "š", 155: "›", 156: "œ", 158: "ž", 159: "Ÿ",
}
_COMMON = ["amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "middot;", "ndash;", "mdash;", "rsquo;"]
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"
# Names that count without a semicolon, the longest first.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))


def _numeric(ref: Column) -> Column:
    """Character of a numeric reference of any length; U+FFFD where the number is no character."""
    digits = F.regexp_replace(ref, r"^&#[xX]?0*|;$", "")
    is_hex = ref.rlike("^&#[xX]")
    too_long = F.length(digits) > F.when(is_hex, 6).otherwise(7)
    shown = F.when(too_long | (digits == ""), F.lit("0")).otherwise(digits)
    code = F.when(is_hex, F.conv(shown, 16, 10)).otherwise(F.conv(shown, 10, 10)).cast("bigint")
    bad = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    valid = F.when(bad, F.lit(0xFFFD).cast("bigint")).otherwise(code)
    char = F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")
    return F.translate(char, "".join(map(chr, _WINDOWS)), "".join(_WINDOWS.values()))


def unescape(text: Column) -> Column:
    """Decode character references by the HTML rules; what is no reference stays as it is."""
    common = literal_map({name: html5[name] for name in _COMMON})
    named = literal_map({name: char for name, char in html5.items() if name.endswith(";") and name not in _COMMON})
    bare = literal_map({name: html5[name] for name in _BARE})

    def decoded(ref: Column) -> Column:
        name = F.substring(ref, F.lit(2), F.length(ref))
        full = F.coalesce(F.try_element_at(common, name), F.try_element_at(named, name))
        head = F.regexp_extract(ref, "^&(" + "|".join(_BARE) + ")", 1)
        begun = F.concat(F.try_element_at(bare, head), F.substring(ref, F.length(head) + 2, F.length(ref)))
        return F.when(ref.startswith("&#"), _numeric(ref)).otherwise(F.coalesce(full, begun, ref))

    # Text between references and the references themselves, woven together.
    between = F.split(text, _REFERENCE)
    refs = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    woven = F.concat_ws(
        "", F.transform(between, lambda part, i: F.concat(part, F.coalesce(decoded(F.get(refs, i)), F.lit(""))))
    )
    return F.when(text.contains("&"), woven).otherwise(text)


def page_tokens(html: Column) -> Column:
    """Visible text pieces between tags, trimmed, in page order."""
    visible = F.regexp_replace(F.regexp_replace(html, _HIDDEN, _BREAK), _TAG, _BREAK)
    parts = F.transform(F.split(visible, _BREAK), lambda t: F.regexp_replace(unescape(t), r"(?U)^\s+|\s+$", ""))
    return F.filter(parts, lambda t: t != "")


def token_rows(df: DataFrame, key: str, html: str) -> DataFrame:
    """One row per token with its 0-based position."""
    return df.select(key, F.posexplode(page_tokens(F.col(html))).alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def marked_segments(tokens: Column, marker) -> Column:
    """Token lists that each start at a token for which ``marker`` holds."""
    starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: marker(F.get(tokens, i)))
    starts = F.when(F.size(tokens) > 0, starts)
    return F.transform(
        starts,
        lambda s, k: F.slice(
            tokens, s + 1, F.coalesce(F.get(starts, k + 1), F.size(tokens)) - s
        ),
    )


def link_ids(df: DataFrame, key: str, html: str, pattern: str = PLAYER_LINK) -> DataFrame:
    """Link text to the number in its address; the last link of a text wins."""
    link = r"(?is)<a\b[^>]*?href\s*=\s*[\"']?[^\"'>]*?" + pattern + r"[^>]*>(.*?)</a\s*>"
    ids = F.regexp_extract_all(html, F.lit(link), F.lit(1))
    texts = F.regexp_extract_all(html, F.lit(link), F.lit(2))
    pairs = F.arrays_zip(ids.alias("id"), texts.alias("text"))
    inner = unescape(F.regexp_replace(F.col("p.text"), _TAG, " "))
    return (
        df.select(key, F.posexplode(pairs).alias("pos", "p"))
        .select(
            key,
            "pos",
            F.trim(F.regexp_replace(inner, r"\s+", " ")).alias("name"),
            F.col("p.id").try_cast("bigint").alias("link_id"),
        )
        .filter((F.col("name") != "") & F.col("link_id").isNotNull())
        .groupBy(key, "name")
        .agg(F.max_by("link_id", "pos").alias("link_id"))
    )


def _scan_lineup(tokens: Column, start: Column) -> Column:
    """Positions of up to nine players after a status token.

    Reads on from ``start``; a position token takes the two tokens after it
    along. ``stop`` is where reading ended.
    """
    at = F.sequence(start + 1, F.greatest(F.size(tokens) - 1, start + 1))
    begin = F.struct(
        (start + 1).alias("next"),
        F.lit(None).cast("int").alias("stop"),
        F.array().cast("array<int>").alias("found"),
    )

    def step(state: Column, i: Column) -> Column:
        token, name = F.get(tokens, i), F.get(tokens, i + 1)
        full = F.size(state["found"]) >= 9
        ends = full | token.isin(END_MARKS) | token.rlike(STATUS_MARK)
        reading = state["stop"].isNull() & (i >= state["next"]) & token.isNotNull()
        spot = reading & ~ends & token.rlike(POSITION_MARK)
        valid = spot & name.isNotNull() & ~name.isin(END_MARKS)
        return F.struct(
            F.when(spot, i + 3).otherwise(state["next"]).alias("next"),
            F.when(reading & ends, i).otherwise(state["stop"]).alias("stop"),
            F.when(F.coalesce(valid, F.lit(False)), F.concat(state["found"], F.array(i)))
            .otherwise(state["found"])
            .alias("found"),
        )

    return F.aggregate(at, begin, step)


def _starter_before(tokens: Column, status: Column) -> Column:
    """Name and hand of the pitcher listed just before a status token."""
    back = F.sequence(status - 1, F.greatest(status - 7, F.lit(0)))
    hits = F.filter(
        F.when(status > 0, back),
        lambda i: (i >= 2) & F.get(tokens, i - 1).rlike(HAND_MARK) & F.get(tokens, i).rlike(ERA_MARK),
    )
    hit = F.get(hits, 0)
    return F.struct(
        F.get(tokens, hit - 2).alias("name"), F.upper(F.get(tokens, hit - 1)).alias("hand")
    )


def card_rows(df: DataFrame, key: str, html: str) -> DataFrame:
    """Lineup page to one row per listed player and probable starter.

    Lists are exploded by the outer forms and empty ones dropped afterwards: for the
    plain forms Spark filters empty lists first, which computes every list once more
    per place where it occurs.
    """
    pages = df.select(
        key,
        F.date_format(page_title_date(F.concat_ws("\n", page_tokens(F.col(html))), PAGE_DATE), "yyyy-MM-dd").alias(
            "game_date"
        ),
        page_tokens(F.col(html)).alias("tokens"),
    )
    games = pages.select(
        key,
        "game_date",
        F.posexplode_outer(marked_segments(F.col("tokens"), lambda t: t.rlike(TIME_MARK))).alias("card", "t"),
    )
    t = F.col("t")
    teams = F.filter(F.transform(t, lambda x: team_code(x, PAGE)), lambda x: x.isin(PAGE_TEAMS))
    status = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: F.get(t, i).rlike(STATUS_MARK))
    found = games.withColumns({"teams": teams, "status": status}).filter(
        (F.size("teams") >= 2) & (F.size("status") >= 2)
    )
    scanned = found.withColumn("away_scan", _scan_lineup(t, F.get("status", F.lit(0))))
    ended = F.coalesce(F.col("away_scan.stop"), F.col("away_scan.next"))
    later = F.filter(F.slice("status", F.lit(2), F.size("status")), lambda i: i > ended)
    home_status = F.coalesce(F.get(later, 0), F.get("status", F.lit(1)))
    sides = scanned.withColumn("home_status", home_status).withColumn(
        "home_scan", _scan_lineup(t, F.col("home_status"))
    )

    def side(me: int, other: int, at: Column, scan: str) -> Column:
        return F.struct(
            F.get("teams", F.lit(me)).alias("team"),
            F.get("teams", F.lit(other)).alias("opponent"),
            F.lit(me == 1).alias("is_home"),
            F.lower(F.regexp_extract(F.get(t, at), STATUS_MARK, 1)).alias("status"),
            _starter_before(t, at).alias("starter"),
            F.col(scan)["found"].alias("found"),
        )

    rows = sides.select(
        key,
        "game_date",
        "t",
        F.inline_outer(
            F.array(
                side(0, 1, F.get("status", F.lit(0)), "away_scan"),
                side(1, 0, F.col("home_status"), "home_scan"),
            )
        ),
    )

    def record(kind: str, name: Column, order: Column, position: Column, hand: Column, state: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"),
            name.alias("player"),
            order.cast("bigint").alias("order"),
            position.alias("position"),
            hand.alias("hand"),
            state.alias("status"),
        )

    def hand_at(i: Column) -> Column:
        return F.when(F.get(t, i).rlike(HAND_MARK), F.upper(F.get(t, i)))

    players = F.transform(
        "found",
        lambda p, i: record(
            "lineup", F.get(t, p + 1), i + 1, F.upper(F.get(t, p)), hand_at(p + 2), F.col("status")
        ),
    )
    none = F.lit(None).cast("string")
    starter = record(
        "starter",
        F.col("starter.name"),
        F.lit(None).cast("bigint"),
        none,
        F.col("starter.hand"),
        F.lit("probable"),
    )
    both = F.concat(F.when(F.col("starter.name").isNotNull(), F.array(starter)).otherwise(F.array().cast(
        "array<struct<record_type:string,player:string,order:bigint,position:string,hand:string,status:string>>"
    )), players)
    return rows.select(
        key, "game_date", "team", "opponent", "is_home", F.explode_outer(both).alias("r")
    ).filter(F.col("r").isNotNull()).select(key, "game_date", "team", "opponent", "is_home", "r.*")
