"""Enumerations of the listing records, in their declaration order (arrays are kept in that order)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DENOMINATION = ["HAPDONG", "TONGHAP", "BAEKSEOK", "GAMLI", "SUNBOK", "BAPTIST", "SEONGGYUL", "GOSIN", "HAPSIN", "ETC", "UNKNOWN"]
PUBLISHABLE_DENOMINATION = [x for x in DENOMINATION if x != "UNKNOWN"]
REGION = [
    "SEOUL", "GYEONGGI", "INCHEON", "GANGWON", "CHUNGBUK", "CHUNGNAM", "DAEJEON", "SEJONG", "GYEONGBUK", "GYEONGNAM", "DAEGU", "ULSAN", "BUSAN",
    "JEONBUK", "JEONNAM", "GWANGJU", "JEJU", "OVERSEAS",
]
POSITION = ["SENIOR_PASTOR", "ASSOCIATE_PASTOR", "EVANGELIST", "LICENSED_MINISTER", "ETC"]
DEPARTMENT = ["INFANT", "CHILDREN", "YOUTH", "YOUNG_ADULT", "DISTRICT", "WORSHIP", "ADMIN", "ETC"]
EMPLOYMENT = ["FULL_TIME", "SEMI_FULL_TIME", "PART_TIME"]
QUALIFICATION = ["ANY", "ENTRY", "EXPERIENCED", "ORDAINED", "SEMINARIAN"]
PERIOD = ["MONTH", "YEAR"]
JOB_KIND = ["MINISTRY", "GENERAL"]
GATE = ["YES", "NO", "UNCERTAIN"]
DENOMINATION_SOURCE = ["stated", "registry", "operator", "inferred", "unknown"]
DEDUP_STATE = ["ALONE", "MASTER", "DUPLICATE", "UNCERTAIN"]
REVIEW_STATUS = ["PENDING", "APPROVED", "REJECTED"]
REJECT_REASON = ["DUPLICATE", "HERESY", "CLOSED", "OPERATOR"]
CONFIDENCE = ["high", "medium", "low"]
HEALTH = ["OK", "EMPTY", "FAIL"]


def member(c: Column, names: list[str]) -> Column:
    """Null or one of the names."""
    return c.isNull() | c.isin(names)


def canonical(values: Column, names: list[str]) -> Column:
    """An enum array without repeats, in declaration order; unknown values go."""
    return F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains(F.coalesce(values, F.array()), n))
