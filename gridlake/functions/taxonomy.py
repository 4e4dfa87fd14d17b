"""Production types: two standardisations and the attribute lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coarse types. The first key contained in the upper-cased name decides.
COARSE_TYPES = [
    ("WIND", "Wind"),
    ("SOLAR", "Solar"),
    ("NUCLEAR", "Nuclear"),
    ("FOSSIL", "Fossil"),
    ("HYDRO", "Hydro"),
    ("BIOMASS", "Biomass"),
    ("GEOTHERMAL", "Geothermal"),
    ("WIND_OFFSHORE", "Wind Offshore"),
    ("WIND_ONSHORE", "Wind Onshore"),
    ("PV", "Solar PV"),
    ("RUN_OF_RIVER", "Run of River"),
    ("PUMPED_STORAGE", "Pumped Storage"),
]

# Fine types. The first row whose words all occur in the lower-cased name decides.
FINE_TYPES = [
    (("solar", "gross"), "Solar gross"),
    (("solar",), "Solar"),
    (("wind", "onshore"), "Wind onshore"),
    (("wind", "offshore"), "Wind offshore"),
    (("wind",), "Wind"),
    (("nuclear",), "Nuclear"),
    (("coal", "brown"), "Brown coal"),
    (("coal", "hard"), "Hard coal"),
    (("coal",), "Coal"),
    (("gas", "fossil"), "Fossil gas"),
    (("gas",), "Gas"),
    (("hydro", "run"), "Hydro Run-of-River"),
    (("hydro", "reservoir"), "Hydro Reservoir"),
    (("hydro",), "Hydro"),
    (("battery",), "Battery Storage (Capacity)"),
    (("biomass",), "Biomass"),
    (("waste",), "Waste"),
    (("oil",), "Oil"),
    (("other",), "Other"),
]

# Plant attributes. The first word contained in the lower-cased name decides.
PLANT_FIELDS = ("production_plant_name", "energy_category", "controllability_type", "description")
PLANT_ATTRIBUTES = [
    ("solar", "Solar", "Renewable", "Weather_Dependent", "Photovoltaic and solar thermal power"),
    ("wind", "Wind", "Renewable", "Weather_Dependent", "Onshore and offshore wind power"),
    ("hydro", "Hydro", "Renewable", "Controllable", "Hydroelectric power"),
    ("nuclear", "Nuclear", "Non-Renewable", "Controllable", "Nuclear power plants"),
    ("coal", "Coal", "Non-Renewable", "Controllable", "Coal-fired power plants"),
    ("gas", "Fossil Gas", "Non-Renewable", "Controllable", "Gas-fired power plants"),
    ("biomass", "Biomass", "Renewable", "Controllable", "Biomass and biogas plants"),
    ("oil", "Oil", "Non-Renewable", "Controllable", "Oil-fired power plants"),
    ("battery", "Battery Storage", "Renewable", "Mixed", "Battery energy storage systems"),
]
OTHER_PLANT = ("Mixed", "Mixed", "Other or unknown type")

# Names the wind report looks for, as the fine types spell them.
WIND_TYPES = ("Wind offshore", "Wind onshore")


def _first_match(branches: list[tuple[Column, Column]], default: Column) -> Column:
    """One CASE over ordered branches."""
    (condition, result), *rest = branches
    case = F.when(condition, result)
    for condition, result in rest:
        case = case.when(condition, result)
    return case.otherwise(default)


def raw_type_key(name: Column) -> Column:
    """The raw name as a key: trimmed and lower-cased, nothing merged."""
    return F.lower(F.trim(name))


def standardize_type(name: Column, taxonomy: str = "fine", key: Column | None = None) -> Column:
    """Standard name of a raw production type; NULL stays NULL.

    `key` may be a column that already holds `raw_type_key(name)`; the fine rules then do not
    trim and lower-case the name once per rule.
    """
    if taxonomy == "coarse":
        text = F.upper(F.trim(name))
        return _first_match([(text.contains(word), F.lit(label)) for word, label in COARSE_TYPES], name)
    if taxonomy == "fine":
        text = raw_type_key(name) if key is None else key
        branches = [
            (reduce(Column.__and__, [text.contains(word) for word in words]), F.lit(label))
            for words, label in FINE_TYPES
        ]
        return _first_match(branches, F.trim(name))
    raise ValueError(f"unknown taxonomy {taxonomy!r}")


def title_case(text: Column) -> Column:
    """Upper-case the first letter after every non-letter (`initcap` only looks at spaces)."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(words, F.initcap), "")


def production_attributes(name: Column) -> Column:
    """Struct of plant name, energy category, controllability and description; NULL for NULL."""
    text = F.lower(name)

    def attributes(values) -> Column:
        return F.struct(*[v.alias(field) for v, field in zip(values, PLANT_FIELDS)])

    branches = [(text.contains(word), attributes([F.lit(v) for v in values])) for word, *values in PLANT_ATTRIBUTES]
    other = attributes([title_case(name), *[F.lit(v) for v in OTHER_PLANT]])
    return F.when(name.isNotNull(), _first_match(branches, other))
