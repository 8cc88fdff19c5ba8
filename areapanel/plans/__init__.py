"""Chains of operators for the real jobs: source features, monthly assembly, publication."""
