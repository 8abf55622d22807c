SELECT goods.codprod, pcdepto.descricao AS departamento, pcsecao.descricao AS secao, pccategoria.categoria
FROM pcprodut AS goods
LEFT JOIN pcdepto USING (codepto)
LEFT JOIN pcsecao ON (pcsecao.codepto, pcsecao.codsec) = (pcdepto.codepto, goods.codsec)
LEFT JOIN pccategoria ON (pccategoria.codsec, pccategoria.codcategoria) = (pcsecao.codsec, goods.codcategoria)
