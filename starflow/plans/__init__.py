"""The retail model: table schemas, specs, and the queries built from them."""
