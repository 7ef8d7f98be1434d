"""Part of crawlsift."""
