"""Location labels used by the usage statistics and the building checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def building_label(location: Column) -> Column:
    """'Bldg …' up to the comma, or 'Bldg ' + two characters after 'Building ', else the text itself."""
    low = F.lower(location)
    bldg_at = F.locate("bldg", low)
    building_at = F.locate("building", low)
    from_bldg = F.substring_index(F.substr(location, bldg_at), ",", 1)
    after_building = F.concat(F.lit("Bldg "), F.substr(location, building_at + 9, F.lit(2)))
    return F.when(bldg_at > 0, from_bldg).when(building_at > 0, after_building).otherwise(location)


def names_a_building(location: Column) -> Column:
    """Keeps building names, and other names free of '.', '/', '(' and ')'."""
    low = F.lower(location)
    return low.contains("bldg") | low.contains("building") | ~location.rlike("[./()]")


def location_class(location: Column) -> Column:
    low = F.lower(location)
    return (
        F.when(low.contains("center"), F.lit("Various Centers"))
        .when(low.contains("room") | low.contains("rm"), F.lit("Various Rooms"))
        .when(location == "Virtual", F.lit("Virtual Events"))
        .when(location == "Online", F.lit("Online Events"))
        .otherwise(location)
    )


def venue_key(location: Column) -> Column:
    return F.lower(strip(location))


def building_by_comma(location: Column) -> Column:
    return strip(F.substring_index(location, ",", 1))


def building_by_comma_or_dash(location: Column) -> Column:
    return strip(
        F.when(location.contains(","), F.substring_index(location, ",", 1)).otherwise(
            F.substring_index(location, "-", 1)
        )
    )
