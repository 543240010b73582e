"""Declarative catalog: measures, source tables, categories.

A ``MeasureSpec`` says how one statistic is aggregated to entity grain
(sum / mean / first / concat), whether it is *extensive* (divided by group
size in group reports) or a *rate*, how it is imputed before clustering and
which segment it is restricted to in per-group histograms.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MeasureSpec:
    name: str
    agg: str = "sum"            # sum | mean | first | concat
    kind: str = "extensive"     # extensive | rate
    impute: str = "zero"        # zero | mean | none
    segment_only: str | None = None   # histogram eligibility (T38)
    alias_of: str | None = None       # same raw measure under another name (T41)


@dataclass(frozen=True)
class TableSpec:
    """One source table: which raw columns are wanted and their final names."""
    name: str
    source: str
    columns: tuple[str, ...]
    rename: dict = field(default_factory=dict)
    key: str = "entity_id"
    table_id: str | None = None       # id of the table on its page


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------

# Group allow-list, in priority order (first hit wins in containment matching).
REFERENCE_GROUP_ALLOW_LIST = [
    "Arsenal", "Aston Villa", "Bournemouth", "Brentford", "Brighton",
    "Chelsea", "Crystal Palace", "Everton", "Fulham", "Ipswich Town",
    "Leicester City", "Liverpool", "Manchester City", "Manchester Utd",
    "Newcastle Utd", "Nott'ham Forest", "Southampton", "Tottenham",
    "West Ham", "Wolves",
]

# Stats that are rates and are not divided by group size.
REFERENCE_RATE_STATS = [
    "Gls_per90", "Ast_per90", "xG_per90", "xAG_per90", "GA90", "Save%", "CS%",
    "PK Save%", "SoT%", "Total Cmp%", "Short Cmp%", "Medium Cmp%", "Long Cmp%",
    "Succ%", "Tkld%", "Won%",
]

# Goalkeeper-only stats in per-group histograms.
REFERENCE_SEGMENT_ONLY_STATS = ["GA90", "Save%", "CS%", "PK Save%"]
REFERENCE_SEGMENT_ONLY_VALUE = "GK"

# Header suffixes by occurrence number for repeated raw headers.
REFERENCE_HEADER_SUFFIXES = {
    "Gls": ["_total", "_per90"],
    "Ast": ["_total", "_per90"],
    "xG": ["_total", "_per90"],
    "xAG": ["_total", "_per90"],
    "Save%": ["_overall", "_pk"],
    "Cmp": ["_total", "_short", "_medium", "_long"],
    "Cmp%": ["_total", "_short", "_medium", "_long"],
    "Tkl": ["_total", "_per90"],
    "PassLive": ["_sca", "_gca"],
    "PassDead": ["_sca", "_gca"],
    "TO": ["_sca", "_gca"],
    "Sh": ["_sca", "_gca"],
    "Fld": ["_sca", "_gca"],
    "Def": ["_sca", "_gca"],
}

# Name normalisation: dropped tokens and alias map.
REFERENCE_STOP_TOKENS = ["de", "andrade"]
REFERENCE_NAME_ALIASES = {
    "rodri": "rodrigo hernandez",
    "j grealish": "jack grealish",
    "grealish": "jack grealish",
    "j stones": "john stones",
    "stones": "john stones",
    "j alvarez": "julian alvarez",
    "alvarez": "julian alvarez",
}

# Strength categories used to explain the best group.
REFERENCE_STRENGTH_CATEGORIES = {
    "offensive": ["Gls", "Ast", "xG", "xAG"],
    "defensive": ["Tkl", "Int", "Blocks"],
    "possession": ["Touches", "Carries", "PrgC_possession"],
}

# Sample-size guards.
MIN_VALUES_TOP_K = 3
MIN_VALUES_HISTOGRAM = 5
MIN_GROUP_MEMBERS = 5
MIN_MODEL_ROWS = 10
HISTOGRAM_BINS = 30
MATCH_THRESHOLD = 75          # a single arg-max at 75 equals the 80-then-75 passes
MISSING_SENTINEL = "N/a"


# ---------------------------------------------------------------------------
# Measure catalog for the driver tables (entity = customer, group = nation,
# segment = market segment). Order is the output order.
# ---------------------------------------------------------------------------

ENTITY_MEASURES = [
    MeasureSpec("n_orders", agg="sum", kind="extensive", impute="zero"),
    MeasureSpec("spend", agg="sum", kind="extensive", impute="zero"),
    MeasureSpec("avg_price", agg="mean", kind="rate", impute="mean"),
    MeasureSpec("acctbal", agg="first", kind="rate", impute="mean"),
    MeasureSpec("qty", agg="sum", kind="extensive", impute="zero"),
    MeasureSpec("n_items", agg="sum", kind="extensive", impute="zero"),
    MeasureSpec("avg_disc", agg="mean", kind="rate", impute="mean",
                segment_only="AUTOMOBILE"),
    MeasureSpec("avg_tax", agg="mean", kind="rate", impute="mean"),
]

STATS = [m.name for m in ENTITY_MEASURES]
EXTENSIVE_STATS = [m.name for m in ENTITY_MEASURES if m.kind == "extensive"]
RATE_STATS = [m.name for m in ENTITY_MEASURES if m.kind == "rate"]
MEAN_IMPUTED = [m.name for m in ENTITY_MEASURES if m.impute == "mean"]
ZERO_IMPUTED = [m.name for m in ENTITY_MEASURES if m.impute == "zero"]

# Strength categories over the driver measures.
STRENGTH_CATEGORIES = {
    "volume": ["n_orders", "n_items", "qty"],
    "value": ["spend", "avg_price"],
    "terms": ["avg_disc", "avg_tax"],
}

# Allow-list of groups for the driver tables (nation names), priority order.
# Built by rule: nations 0..19 in key order (so NATION_1 precedes NATION_10,
# which exercises first-hit priority in containment matching).
GROUP_ALLOW_LIST = [f"NATION_{i}" for i in range(20)]


# ---------------------------------------------------------------------------
# The reference's source catalog (raw header -> final name per
# table; raw repeats carry pandas' '.1' suffix) and its 75 stats in output
# order, with the 21 mean-aggregated ones, the 16 imputed by mean before
# clustering and the 4 left out of clustering.
# ---------------------------------------------------------------------------
REFERENCE_TABLES = {
    "standard": {"Player": "Player", "Nation": "Nation", "Pos": "Pos", "Squad": "Squad",
                 "Age": "Age", "MP": "MP", "Starts": "Starts", "Min": "Min", "Gls": "Gls",
                 "Ast": "Ast", "CrdY": "CrdY", "CrdR": "CrdR", "xG": "xG", "npxG": "npxG",
                 "xAG": "xAG", "PrgC": "PrgC_standard", "PrgP": "PrgP_standard",
                 "PrgR": "PrgR_standard", "Gls.1": "Gls_per90", "Ast.1": "Ast_per90",
                 "xG.1": "xG_per90", "xAG.1": "xAG_per90"},
    "goalkeeping": {"Player": "Player", "GA90": "GA90", "Save%": "Save%", "CS%": "CS%",
               "Save%.1": "PK Save%"},
    "shooting": {"Player": "Player", "SoT%": "SoT%", "SoT/90": "SoT/90", "G/Sh": "G/Sh",
                 "Dist": "Dist"},
    "passing": {"Player": "Player", "Cmp": "Total Cmp", "Cmp%": "Total Cmp%",
                "TotDist": "TotDist_passing", "Cmp%.1": "Short Cmp%", "Cmp%.2": "Medium Cmp%",
                "Cmp%.3": "Long Cmp%", "KP": "KP", "1/3": "1/3_passing", "PPA": "PPA",
                "CrsPA": "CrsPA", "PrgP": "PrgP_passing"},
    "gca": {"Player": "Player", "SCA": "SCA", "SCA90": "SCA90", "GCA": "GCA", "GCA90": "GCA90"},
    "defense": {"Player": "Player", "Tkl": "Tkl", "TklW": "TklW", "Att": "Att_defense",
                "Lost": "Lost_defense", "Blocks": "Blocks", "Sh": "Sh_defense",
                "Pass": "Pass_defense", "Int": "Int"},
    "possession": {"Player": "Player", "Touches": "Touches", "Def Pen": "Def Pen",
                   "Def 3rd": "Def 3rd", "Mid 3rd": "Mid 3rd", "Att 3rd": "Att 3rd",
                   "Att Pen": "Att Pen", "Att": "Att (Take-Ons)", "Succ%": "Succ%",
                   "Tkld%": "Tkld%", "Carries": "Carries", "TotDist": "TotDist (Carries)",
                   "PrgDist": "PrgDist (Carries)", "PrgC": "PrgC_possession",
                   "1/3": "1/3 (Carries)", "CPA": "CPA", "Mis": "Mis", "Dis": "Dis",
                   "Rec": "Rec", "PrgR": "PrgR (Receiving)"},
    "misc": {"Player": "Player", "Fls": "Fls", "Fld": "Fld", "Off": "Off", "Crs": "Crs",
             "Recov": "Recov", "Won": "Won", "Lost": "Lost_misc", "Won%": "Won%"},
}
REFERENCE_DESCRIPTORS = {"Player": "first", "Nation": "first", "Squad": "concat",
                         "Pos": "first", "Age": "first"}
REFERENCE_STATS = [
    "MP", "Starts", "Min", "Gls", "Ast", "CrdY", "CrdR", "xG", "npxG", "xAG",
    "PrgC_standard", "PrgP_standard", "PrgR_standard", "Gls_per90", "Ast_per90", "xG_per90",
    "xAG_per90", "GA90", "Save%", "CS%", "PK Save%", "SoT%", "SoT/90", "G/Sh", "Dist",
    "Total Cmp", "Total Cmp%", "TotDist_passing", "Short Cmp%", "Medium Cmp%", "Long Cmp%",
    "KP", "1/3_passing", "PPA", "CrsPA", "PrgP_passing", "SCA", "SCA90", "GCA", "GCA90",
    "Tkl", "TklW", "Att_defense", "Lost_defense", "Blocks", "Sh_defense", "Pass_defense", "Int",
    "Touches", "Def Pen", "Def 3rd", "Mid 3rd", "Att 3rd", "Att Pen", "Att (Take-Ons)", "Succ%",
    "Tkld%", "Carries", "TotDist (Carries)", "PrgDist (Carries)", "PrgC_possession",
    "1/3 (Carries)", "CPA", "Mis", "Dis", "Rec", "PrgR (Receiving)", "Fls", "Fld", "Off", "Crs",
    "Recov", "Won", "Lost_misc", "Won%",
]
REFERENCE_MEAN_STATS = [
    "Gls_per90", "Ast_per90", "xG_per90", "xAG_per90", "GA90", "Save%", "CS%", "PK Save%",
    "SoT%", "SoT/90", "G/Sh", "Dist", "Total Cmp%", "Short Cmp%", "Medium Cmp%", "Long Cmp%",
    "SCA90", "GCA90", "Succ%", "Tkld%", "Won%",
]
REFERENCE_MEAN_IMPUTED = [
    "Gls_per90", "Ast_per90", "xG_per90", "xAG_per90", "SoT%", "G/Sh", "Dist", "Total Cmp%",
    "Short Cmp%", "Medium Cmp%", "Long Cmp%", "SCA90", "GCA90", "Succ%", "Tkld%", "Won%",
]
REFERENCE_NOT_CLUSTERED = ["GA90", "Save%", "CS%", "PK Save%"]
REFERENCE_MIN_COLUMN, REFERENCE_MIN_ABOVE = "Min", 90
# The same raw measure under two names (T41): copy -> original.
REFERENCE_ALIASES = {"PrgP_passing": "PrgP_standard", "PrgC_possession": "PrgC_standard",
                     "PrgR (Receiving)": "PrgR_standard"}


# Page of each table, where it is not named like the table.
REFERENCE_URL_TYPES = {"standard": "stats", "goalkeeping": "keepers"}


def reference_table_specs() -> list[TableSpec]:
    """The reference catalog as ``TableSpec`` rows; ``source`` is the URL
    fragment naming the page of each table, ``table_id`` its id there."""
    out = []
    for name, cols in REFERENCE_TABLES.items():
        page = REFERENCE_URL_TYPES.get(name, name)
        out.append(TableSpec(name=name, source=f"/{page}/", columns=tuple(cols),
                             rename=dict(cols), table_id=f"stats_{page}_9"))
    return out


def suffixed_header(expected: str, suffixes: dict[str, list[str]] | None = None) -> str:
    """Disambiguated header of a wanted column: ``Gls`` -> ``Gls_total``,
    ``Gls.1`` -> ``Gls_per90``; columns that never repeat keep their name."""
    suffixes = REFERENCE_HEADER_SUFFIXES if suffixes is None else suffixes
    base, dot, k = expected.rpartition(".")
    if dot and k.isdigit() and base in suffixes:
        return base + suffixes[base][min(int(k), len(suffixes[base]) - 1)]
    return expected + suffixes[expected][0] if expected in suffixes else expected


def reference_measures() -> list[MeasureSpec]:
    """75 stats: mean-aggregated ones are rates for group reports except the
    five that the reference still divides by group size (T11)."""
    out = []
    for s in REFERENCE_STATS:
        agg = "mean" if s in REFERENCE_MEAN_STATS else "sum"
        kind = "rate" if s in REFERENCE_RATE_STATS else "extensive"
        imp = ("none" if s in REFERENCE_NOT_CLUSTERED
               else "mean" if s in REFERENCE_MEAN_IMPUTED else "zero")
        seg = REFERENCE_SEGMENT_ONLY_VALUE if s in REFERENCE_SEGMENT_ONLY_STATS else None
        out.append(MeasureSpec(s, agg=agg, kind=kind, impute=imp, segment_only=seg,
                               alias_of=REFERENCE_ALIASES.get(s)))
    return out


def without_aliases(measures: list[MeasureSpec]) -> list[MeasureSpec]:
    """Drop measures that repeat another under a second name, so clustering
    and overall scores do not weight them twice (T41). The parity preset
    keeps them."""
    return [m for m in measures if m.alias_of is None]
