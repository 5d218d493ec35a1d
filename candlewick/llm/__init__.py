"""Training-data operators: fingerprints, extraction, filters, language, de-duplication, toxicity,
nearest neighbours, packing, sub-word encoding and source mixing."""
