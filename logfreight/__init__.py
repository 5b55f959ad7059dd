"""Package log records for delivery and account for what became of them, on Spark."""

from logfreight.model import DeliveryOptions, PackOptions

__all__ = ["DeliveryOptions", "PackOptions"]
