"""lotledger.sources"""
