"""Sources: raw CSV / path / catalog scans, bronze audit, star-schema adapter."""
