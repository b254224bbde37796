"""Operations on training text: counting, fingerprints, filters, packing, archives, formatting."""
