"""Column functions: masks, detectors, filters, encryption, cron."""
