"""Business analytics over three domains (shop, supply chain, ledger) as Spark jobs."""
