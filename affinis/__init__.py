"""Entity profiles, similarity and a binary classifier as Spark DataFrame jobs."""

from affinis.spec import LIVESTOCK, ProfileSpec

__all__ = ["LIVESTOCK", "ProfileSpec"]
