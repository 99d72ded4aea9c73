"""lotledger.streaming"""
