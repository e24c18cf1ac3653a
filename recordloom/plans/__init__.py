"""Query plans: feeds over the driver's tables and one module per operator family."""

from importlib import import_module

MODULES: tuple[str, ...] = (
    "q_verify",
    "q_fields",
    "q_tables",
    "q_sections",
    "q_lookups",
    "q_dedup",
    "q_merge",
    "q_records",
    "q_layout",
    "q_io",
    "q_fallbacks",
    "q_flows",
)


def load_all() -> None:
    for m in MODULES:
        import_module(f"{__name__}.{m}")
