"""Record linkage and golden records on Spark."""

from kithline.config import LinkageConfig, Rule
from kithline.plans.resolver import Resolution, Resolver

__all__ = ["LinkageConfig", "Resolution", "Resolver", "Rule"]
