"""The default prompt. Any text with the same three placeholders can replace it."""

# --- fixed values: placeholders and doubled braces ---------------------------
# {cluster_id}, {palavras_chave} and {exemplos} are filled in; {{ and }} stand
# for single braces.
DEFAULT_TEMPLATE = """Dê um rótulo a um grupo de notícias parecidas.

Use apenas as palavras-chave e os exemplos abaixo. Responda só com um objeto JSON:

{{"cluster_id": número recebido, "nome_topico": nome específico de 3 a 6 palavras,
"palavras_chave": de 3 a 8 termos, "resumo": 1 ou 2 frases,
"nivel_confianca": número de 0 a 1, "possivel_ruido": true ou false}}

Nomes vagos como "Geral" ou "Outros" não são aceitos. Se os exemplos tratarem de
assuntos diferentes, marque possivel_ruido e dê confiança menor que 0.5.

cluster_id: {cluster_id}
palavras_chave: {palavras_chave}
exemplos:
{exemplos}
"""
