from parcelkit.functions import numeric, stats, text  # noqa: F401
