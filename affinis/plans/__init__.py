"""Registered queries. Importing the modules fills the registry."""

from affinis.plans import classification, profile, recommendation, similarity, spatial, text
from affinis.plans.registry import REGISTRY

__all__ = ["REGISTRY", "classification", "profile", "recommendation", "similarity", "spatial", "text"]
