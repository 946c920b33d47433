"""Entity/route catalogue (S5) and user registration of new routes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Route:
    endpoint: str
    version: str
    cost: int


# The source API's routes with their version and token cost.
ROUTES: dict[str, Route] = {r.endpoint: r for r in (
    Route("/activities", "v2", 10),
    Route("/activityFields", "v1", 20),
    Route("/activityTypes", "v1", 20),
    Route("/currencies", "v1", 20),
    Route("/dealFields", "v1", 20),
    Route("/deals", "v2", 10),
    Route("/deals/detail/changelog", "v1", 20),
    Route("/deals/detail/flow", "v1", 40),
    Route("/filters", "v1", 20),
    Route("/leadLabels", "v1", 10),
    Route("/leads", "v1", 20),
    Route("/organizationFields", "v1", 20),
    Route("/organizations", "v2", 10),
    Route("/personFields", "v1", 20),
    Route("/persons", "v2", 10),
    Route("/persons/detail", "v2", 1),
    Route("/pipelines", "v2", 5),
    Route("/stages", "v2", 5),
    Route("/users", "v1", 20),
)}


def register_route(endpoint: str, version: str, cost: int) -> Route:
    """Add a route (a new paged entity); readers pick it up by name."""
    r = Route(endpoint, version, cost)
    ROUTES[endpoint] = r
    return r


def routes_frame(spark: SparkSession) -> DataFrame:
    """The catalogue as a small DataFrame (for cost joins)."""
    return spark.createDataFrame([(r.endpoint, r.version, r.cost) for r in ROUTES.values()],
                                 "endpoint string, version string, cost int")
