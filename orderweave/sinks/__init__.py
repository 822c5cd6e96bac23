"""Writing datasets to warehouse tables."""

from .warehouse import Target, replace, replace_period, replace_periods, with_source_text_dates, with_text_dates

__all__ = ["Target", "replace", "replace_period", "replace_periods", "with_source_text_dates", "with_text_dates"]
