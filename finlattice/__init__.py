"""Filing analytics as DataFrame operators: extracted statements to audited facts, at any number of companies."""
