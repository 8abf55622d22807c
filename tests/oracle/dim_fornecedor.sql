SELECT DISTINCT codfornec AS cod_fornecedor, fornecedor AS nm_fornecedor,
       CASE WHEN classificacao = 'F' THEN 'FARMA' WHEN classificacao = 'H' THEN 'HB' ELSE 'OUTROS' END AS classificacao
FROM pcfornec WHERE revenda = 'S'
