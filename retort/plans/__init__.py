"""The library's operators as queries over the driver's tables, each beside its SQL."""
