"""Cleaning of building energy records.

Each imputation reads its input several times (once per key set), so the input is staged
before it; without that, plans would nest and grow with every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators.columns import q, raise_total
from tallyweave.operators.ordered import cascade_impute
from tallyweave.session import spread, staged

# Names of the record columns, limits and unit factors of the domain.
TYPE, PRIMARY, AREA, DECADE = "BuildingType", "PrimaryPropertyType", "Neighborhood", "DecadeBuilt"
TOTAL, BUILDING, PARKING = "PropertyGFATotal", "PropertyGFABuilding(s)", "PropertyGFAParking"
LARGEST = "LargestPropertyUseType"
USES = ("LargestPropertyUseTypeGFA", "SecondLargestPropertyUseTypeGFA", "ThirdLargestPropertyUseTypeGFA")
ENERGY = ("NaturalGas(kBtu)", "Electricity(kBtu)", "SteamUse(kBtu)")
SITE = "SiteEnergyUse(kBtu)"
MOST_FLOORS = 76
MOST_PARKING = 4
KBTU_PER_KWH = 3.413
KBTU_PER_THERM = 99.976

# Key sets for imputation, finest first.
BY_USE = [[PRIMARY, TYPE, AREA], [PRIMARY, AREA], [PRIMARY, TYPE], [PRIMARY]]
BY_AGE = [[PRIMARY, TYPE, AREA, DECADE], [PRIMARY, AREA, DECADE], [PRIMARY, TYPE, DECADE], [PRIMARY, DECADE], [PRIMARY]]
BY_PLACE = [[PRIMARY, TYPE, AREA, DECADE], [PRIMARY, TYPE, DECADE], [AREA, TYPE, DECADE], [AREA, TYPE]]
BY_ANY = [*BY_PLACE, [PRIMARY, DECADE], [DECADE], [PRIMARY], [TYPE]]
BY_LARGEST = [
    [PRIMARY, TYPE, AREA, DECADE],
    [PRIMARY, TYPE, DECADE],
    [AREA, LARGEST, DECADE],
    [AREA, LARGEST],
    [LARGEST, DECADE],
    [DECADE],
    [LARGEST],
    [TYPE],
]


def non_residential(df: DataFrame) -> DataFrame:
    """Records whose type and use do not mention families, texts in upper case, types grouped."""
    kept = df.filter(X.not_contains(q(TYPE), "family") & X.not_contains(q(PRIMARY), "family"))
    upper = kept.withColumns({c: F.upper(q(c)) for c, kind in kept.dtypes if kind == "string"})
    return upper.withColumns(
        {TYPE: X.group_values(q(TYPE), ["NONRESIDENTIAL"]), AREA: X.group_values(q(AREA), ["DELRIDGE"])}
    )


def areas_and_counts(df: DataFrame) -> DataFrame:
    """Use areas filled and made consistent with the total; building and floor counts bounded and filled."""
    df = df.withColumns(
        {
            USES[1]: F.coalesce(q(USES[1]), F.lit(0.0)),
            USES[2]: F.coalesce(q(USES[2]), F.lit(0.0)),
            "SecondLargestPropertyUseType": F.coalesce(q("SecondLargestPropertyUseType"), F.lit("")),
            "ThirdLargestPropertyUseType": F.coalesce(q("ThirdLargestPropertyUseType"), F.lit("")),
            DECADE: N.round_to_bucket(q("YearBuilt"), 5),
            "NumberofFloors": N.within(q("NumberofFloors"), 0, MOST_FLOORS),
        }
    ).drop("YearBuilt", "Comments", "YearsENERGYSTARCertified")
    df = staged(cascade_impute(df, LARGEST, [[PRIMARY]], "mode"), "uses")
    df = cascade_impute(df, [USES[0], BUILDING], BY_USE)
    df = staged(raise_total(df, TOTAL, BUILDING, USES), "areas")
    return cascade_impute(df, ["NumberofBuildings", "NumberofFloors"], BY_AGE)


def parking(df: DataFrame) -> DataFrame:
    """Parking share of the building area bounded, filled and turned back into an area."""
    share = N.within(N.ratio(q(PARKING), q(BUILDING)), None, MOST_PARKING)
    df = cascade_impute(df.withColumn("parking_ratio", share), "parking_ratio", BY_PLACE)
    return df.withColumn(PARKING, q(BUILDING) * q("parking_ratio"))


def energy(df: DataFrame) -> DataFrame:
    """Energies in one unit, impossible values out, site use from its parts, shares and intensities filled."""
    gas, power, steam = ENERGY
    df = df.withColumns(
        {
            power: N.within(N.fill_scaled(q(power), q("Electricity(kWh)"), KBTU_PER_KWH), 0),
            gas: N.within(N.fill_scaled(q(gas), q("NaturalGas(therms)"), KBTU_PER_THERM), 0),
            steam: F.coalesce(q(steam), F.lit(0.0)),
            SITE: F.when(q(SITE) > 0, q(SITE)),
        }
    ).drop("Electricity(kWh)", "NaturalGas(therms)")
    df = df.withColumn(SITE, N.fill_sum(q(SITE), [q(c) for c in ENERGY]))
    df = df.withColumns(
        {
            "SiteEUIWN(kBtu/sf)": N.within(q("SiteEUIWN(kBtu/sf)"), 0),
            "GHGEmissionsIntensity": N.within(q("GHGEmissionsIntensity"), 0),
            "gas_ratio": N.ratio(q(gas), q(SITE)),
            "electricity_ratio": N.ratio(q(power), q(SITE)),
            "steam_ratio": N.ratio(q(steam), q(SITE)),
            "largest_property_use_type_ratio": N.ratio(q(USES[0]), q(TOTAL)),
            "second_largest_property_use_type_ratio": N.ratio(q(USES[1]), q(TOTAL)),
            "third_largest_property_use_type_ratio": N.ratio(q(USES[2]), q(TOTAL)),
        }
    )
    df = cascade_impute(staged(df, "energy"), ["SiteEUIWN(kBtu/sf)", "GHGEmissionsIntensity"], BY_LARGEST)
    return cascade_impute(staged(df, "intensity"), ["gas_ratio", "electricity_ratio", "steam_ratio"], BY_ANY)


# Columns the cleaned table does not keep.
DROPPED = (
    "Outlier",
    "ComplianceStatus",
    "DefaultData",
    "NaturalGas(kBtu)",
    "Electricity(kBtu)",
    "SteamUse(kBtu)",
    "SiteEnergyUseWN(kBtu)",
    "SourceEUIWN(kBtu/sf)",
    "SourceEUI(kBtu/sf)",
    "SiteEUI(kBtu/sf)",
    "Longitude",
    "Latitude",
    "DataYear",
    "PropertyName",
    "Address",
    "City",
    "State",
    "ZipCode",
    "TaxParcelIdentificationNumber",
    "CouncilDistrictCode",
    "SiteEnergyUse(kBtu)",
    "TotalGHGEmissions",
    "ListOfAllPropertyUseTypes",
    "PropertyGFAParking",
    "LargestPropertyUseTypeGFA",
    "SecondLargestPropertyUseTypeGFA",
    "ThirdLargestPropertyUseTypeGFA",
)


def clean_buildings(df: DataFrame, keep_id: bool = True) -> DataFrame:
    """The whole cleaning; the record id stays unless told otherwise."""
    df = staged(areas_and_counts(spread(non_residential(df))), "counts")
    out = energy(staged(parking(df), "parking")).drop(*DROPPED)
    return out if keep_id else out.drop("OSEBuildingID")
